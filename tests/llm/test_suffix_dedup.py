import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import suffix_dedup
from sieveflow.llm.queries import op5_suffix_dedup
from sieveflow.llm.suffix_dedup import common_prefixes, remove_repeated, repeated_windows, runs, suffix_array


def plain_windows(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    return [np.array([seen[t[i:i + length]] > 1 for i in range(len(t) - length + 1)], dtype=bool) for t in texts]


def plain_removal(texts, length=400):
    out = []
    for t, flags in zip(texts, plain_windows(texts, length)):
        gone = np.zeros(len(t), dtype=bool)
        for i in np.flatnonzero(flags):
            gone[i:i + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        t = bytes(rng.choices(b"ab\0", k=rng.randrange(1, 200)))
        order, rank = suffix_array(t)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:]) and (rank[order] == np.arange(len(t))).all()
        shared = common_prefixes(t, order, rank, 7)
        for k in range(1, len(t)):
            a, b = t[order[k - 1]:], t[order[k]:]
            assert shared[k] == min(7, next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))


def test_repeated_windows():
    rng = random.Random(2)
    for _ in range(80):
        parts = [bytes(rng.choices(b"abcdef", k=rng.randrange(1, 60))) for _ in range(4)]
        texts = [b"".join(rng.choices(parts, k=rng.randrange(5))) for _ in range(5)]
        if any(texts):
            for got, want in zip(repeated_windows(texts, 20), plain_windows(texts, 20)):
                assert (got == want).all()


def test_equal_windows_lie_in_runs_of_equal_hash(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    monkeypatch.setattr(suffix_dedup, "LONGEST_RUN", 150)
    rng = random.Random(4)
    passage = bytes(rng.choices(b"abcdefgh ", k=900))
    hashes = []
    for before in (0, 13, 1000):
        t = bytes(rng.choices(b"xyz ", k=before)) + passage
        m, _, at, n, _ = runs(t, 400)
        assert n.sum() == len(t) - 399 and (at[1:] == at[:-1] + n[:-1]).all() and n.max() <= 150
        hashes.append(np.repeat(m, n)[before:])
    assert (hashes[0] == hashes[1]).all() and (hashes[0] == hashes[2]).all()


def corpus(seed=5):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices("abcdefg é", k=k))
    common, other = word(700), word(450)
    rows = [(100 + i, word(rng.randrange(900)) + common + word(rng.randrange(900)), "en", "a", 1) for i in range(25)]
    rows += [(200 + i, word(300) + other[i:] + word(300), "en", "b", 1) for i in range(3)]
    rows += [(300, "periodic " * 200, "en", "b", 1), (301, word(399), "en", "b", 1), (302, word(50) + word(0) + "z" * 401, "en", "b", 1)]
    return ODD + rows + [rows[0]]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3000])
def test_removal(spark, monkeypatch, shard_bytes):
    """With small shards a hash is split, and its windows are merged by their fingerprints."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", 500)
    rows = corpus()
    got = remove_repeated(odd_docs(spark, True, rows))
    want = Counter((r[0], *w) for r, w in zip(rows, plain_removal([(r[1] or "").encode() for r in rows])))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want


def test_query_on_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {d.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest())
            for d, w in zip(docs, plain_removal([(d.text or "").encode() for d in docs]))}
    for r in op5_suffix_dedup(spark, sf_dir).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_empty(spark):
    assert rows_of(remove_repeated(empty_docs(spark))) == []


def test_many_copies_of_one_row(spark):
    """Repeated rows are one text with one list of spans: time and memory in proportion to the rows."""
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefgh é", k=3000))
    rows = [(7, text, "en", "a", 1)] * 20_000 + [(None, text, "en", "a", 1)] * 500 + [(8, text[:2000] + "other", "en", "a", 1), (9, text[:500], "en", "a", 1)]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeated(odd_docs(spark, True, rows).repartition(8)).select(
        "doc_id", "n_bytes", "n_removed").collect())
    n, shared, short = len(text.encode()), len(text[:2000].encode()), len(text[:500].encode())
    assert got == {(7, n, n): 20_000, (None, n, n): 500, (8, shared + 5, shared): 1, (9, short, short): 1}


def test_planted_passages(spark):
    """Passages of 400 to 600 bytes, some between characters of several bytes, go from all documents; clean documents stay whole."""
    rng = random.Random(12)
    word = lambda k, letters="abcdefghijklm ": "".join(rng.choices(letters, k=k))
    passages = [word(rng.randrange(400, 600)) for _ in range(12)] + [word(rng.randrange(380, 450), "é日abc ") for _ in range(12)]
    rows, planted = [], []
    for i in range(400):
        before, after = word(rng.randrange(900), "é日xyz "), word(rng.randrange(900), "éuvw ")
        p = rng.choice(passages) if i % 4 == 0 else ""
        rows.append((i, before + p + after, "en", "a", 1))
        planted.append(p)
    got = {r.doc_id: r for r in remove_repeated(odd_docs(spark, False, rows)).collect()}
    want = plain_removal([r[1].encode() for r in rows])
    for (i, text, *_), p, w in zip(rows, planted, want):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == tuple(w)
        assert (p.encode() in bytes(got[i].kept)) == (not p) if planted.count(p) > 1 and len(p.encode()) >= 400 else True
        if not p:
            assert got[i].n_removed == 0
