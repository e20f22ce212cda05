import random
import re

import xxhash

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import simhash
from sieveflow.llm.common import Scratch
from sieveflow.llm.simhash import components, drop_near_copies, fingerprint, links, near_groups

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not words:
        return 0
    parts = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    """index -> smallest index reachable, over links of at most two bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    for _, text, *_ in ODD:
        assert fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_links_connect_as_all_pairs_do(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(rng.randrange(12)):
            base ^= 1 << rng.randrange(64)
            base ^= (1 << rng.randrange(64)) * rng.randrange(2)
            prints.append(base)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(links(df), Scratch(spark, "test")).collect()}
    want = plain_components(prints)
    got = [roots.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < len(prints)


def test_large_list_of_near_fingerprints(spark):
    """Two bytes vary freely: one list holds them all, and its links stay fewer than its members."""
    df = spark.range(0, 65536, 7).selectExpr("id AS fp")
    found = links(df)
    n = df.count()
    assert found.where("b > 255 OR a > 0").count() < 30 * n


def test_near_groups(spark):
    rows = ODD + [(20 + i, "lorem ipsum dolor sit amet " * 40 + f"end {i}", "en", "a", 1) for i in range(6)]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in near_groups(odd_docs(spark, True, rows)).collect()}
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(prints)
    for r, p, c in zip(rows, prints, roots):
        ids = [rows[i][0] for i in range(len(rows)) if roots[i] == c and rows[i][0] is not None]
        assert got[r[0], f"{p:016x}"] == min(ids, default=None)


def test_drop_near_copies(spark):
    docs = odd_docs(spark, clash=True)
    got = drop_near_copies(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 not in ids and 6 not in ids


def test_empty(spark):
    assert rows_of(near_groups(empty_docs(spark))) == [] and rows_of(drop_near_copies(empty_docs(spark))) == []


def test_rows_without_or_with_repeated_ids_are_judged_by_their_text(spark):
    rows = [(None, f"text {c} of its own with words {c * 7}", "en", "a", 1) for c in "abcdefgh"]
    rows += [(5, "one text under this id is about rivers", "en", "a", 1), (5, "another speaks of quarks and leptons", "en", "a", 1)]
    rows += [(9, rows[0][1], "en", "a", 1), (None, rows[1][1], "en", "b", 1)]
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(prints)
    got = [(r.doc_id, r.text) for r in drop_near_copies(odd_docs(spark, True, rows)).collect()]
    assert len(got) == len(set(roots)) > 8
    assert (9, rows[0][1]) in got and (None, rows[0][1]) not in got
    assert {t for i, t in got if i == 5} == {rows[8][1], rows[9][1]}
