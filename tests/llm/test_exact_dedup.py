import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import CLASH, ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import exact_dedup
from sieveflow.llm.exact_dedup import drop_copies, exact_groups

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(FOLD)].append(r[0])
    out = {}
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        out[norm] = (None if not known else (max if keep == "largest" else min)(known), len(ids))
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_groups(spark, keep):
    want = brute(ODD, keep)
    got = exact_groups(odd_docs(spark, clash=True), keep=keep).collect()
    assert len(got) == len(ODD)
    by_digest = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in want.items()}
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == by_digest[r.text_sha256]
        kept[r.text_sha256] += r.kept
    assert all(n == 1 for n in kept.values()) and len(kept) == len(want)


def test_many_copies_are_cut_into_runs(spark):
    rows = [(i, "Same TEXT" if i % 3 else f"own {i}", "en", "a", 1) for i in range(3000)]
    got = exact_groups(odd_docs(spark, rows=rows), keep="largest").collect()
    assert sum(r.kept for r in got) == 1001
    assert {(r.keep_id, r.group_size) for r in got if r.group_size > 1} == {(2999, 2000)}


def test_drop_copies_keeps_all_columns(spark):
    docs = odd_docs(spark, clash=True)
    got = drop_copies(docs, keep="largest")
    assert got.columns == docs.columns and set(CLASH) <= set(got.columns)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted(
        [(False, i) for i in (2, 4, 5, 6, 7, 8, 9)] + [(True, 0)])


def test_empty(spark):
    assert rows_of(exact_groups(empty_docs(spark))) == [] and rows_of(drop_copies(empty_docs(spark))) == []


def test_neighbours_decide_what_is_equal(spark, monkeypatch):
    """Texts that begin alike and had one digest: only the full comparison of neighbours tells them apart."""
    monkeypatch.setattr(exact_dedup, "_digest", lambda norm: F.lit("00"))
    rows = [(i, "the same beginning of many texts " + "abc"[i % 3] * (i % 2), "en", "a", 1) for i in range(300)]
    want = brute(rows, "largest")
    docs = odd_docs(spark, rows=rows)
    got = exact_groups(docs, keep="largest").collect()
    assert sorted((r.keep_id, r.group_size) for r in got) == sorted(want[t] for _, t, *_ in rows)
    assert {r.doc_id for r in got if r.kept} == {k for k, _ in want.values()} == {r.doc_id for r in drop_copies(docs, keep="largest").collect()}


def test_ties_are_settled_the_same_way(spark):
    rows = [(1, "a text", "en", s, n) for n, s in enumerate("abcdefgh")]
    kept = [drop_copies(odd_docs(spark, rows=r).repartition(k)).collect() for r, k in ((rows, 1), (rows[::-1], 3), (rows[3:] + rows[:3], 7))]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 1
