import re
from collections import Counter, defaultdict

import pytest

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import mixing
from sieveflow.llm.mixing import mix, mixed


def plain_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        left = share * sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in free)
        target = {s: left * weight[s] / total for s in free}
        above = [s for s in free if target[s] > most * sizes[s]]
        if not above:
            return target | capped
        capped |= {s: most * sizes[s] for s in above}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus(n=3000):
    return [(i, "w " * (1 + i * 37 % 211), "en", None if i % 29 == 0 else "abcde"[min(i % 9, 4)], 1) for i in range(n)]


def test_targets_and_sums(spark):
    rows = corpus()
    got = mix(odd_docs(spark, clash=True, rows=rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    source = {r[0]: r[3] for r in rows}
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = plain_targets(dict(sizes))
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken % r.size == 0 and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_reruns_agree(spark):
    rows = corpus(400)
    first = rows_of(mix(odd_docs(spark, rows=rows)))
    assert first == rows_of(mix(odd_docs(spark, rows=rows[::-1]).repartition(3)))


def test_all_levels_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 3)
    test_targets_and_sums(spark)


def test_fractions_are_kept_on_average(spark):
    rows = [(i, "w w w", "en", "ab"[i % 2], 1) for i in range(4000)]
    got = mix(odd_docs(spark, rows=rows)).collect()  # a: 2 times its size, b: once
    per = defaultdict(Counter)
    for r in got:
        per[r.doc_id % 2][r.taken] += 1
    assert per[0][6] == 2000 and per[1][3] == 2000
    rows = [(i, "w w w", "en", "abc"[i % 3], 1) for i in range(3000)]
    copies = Counter(r.taken for r in mix(odd_docs(spark, rows=rows), weights=(1.0, 1.0, 1.0)).collect())
    assert abs(copies[6] - copies[3]) <= 6 and copies[0] == 0


def test_odd_rows(spark):
    got = mix(odd_docs(spark, clash=True)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ODD)
    assert all(r.taken == 0 for r in got if r.doc_id in (3, 4, 6))
    docs = odd_docs(spark, clash=True)
    out = mixed(docs)
    assert out.columns == docs.columns
    counted = Counter((r.doc_id, r.text) for r in out.collect())
    words = sum(n * size(t) for (_, t), n in counted.items())
    assert words == sum(r.taken for r in got)
    assert all(n <= 2 * Counter((r[0], r[1]) for r in ODD)[k] for k, n in counted.items())


def test_empty(spark):
    assert rows_of(mix(empty_docs(spark))) == [] and rows_of(mixed(empty_docs(spark))) == []
