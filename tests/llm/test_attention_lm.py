import math
import re
import uuid
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import attention_lm as lm, common
from sieveflow.llm.attention_lm import Vocabulary, log_probabilities

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def characters() -> Vocabulary:
    """Bytes as ids."""
    def load():
        return lambda words: (np.array([b for w in words for b in b" " + w.encode()]), np.array([1 + len(w.encode()) for w in words]))

    return Vocabulary(load, 256, [bytes([i]) for i in range(256)])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def plain_base(rows):
    train = [words(t) for i, t in rows if i is not None and not held(i)]
    counts = Counter(w for ws in train for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = [*words(t), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, base))
    return out


def same_base(got, rows):
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 6))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(plain_base(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def plain_score(model, table, ids, end):
    """One document, id by id, as plain attention over the window that scores it."""
    m = {n: v.astype(np.float64) for n, v in model.items()}
    row, total = [end] * (lm.CONTEXT + 1) + ids + [end], 0.0
    for j in range(len(ids) + 1):
        first = j // lm.STRIDE * lm.STRIDE
        x = [table.slot[t] for t in row[first: lm.CONTEXT + 1 + j]]
        s = m["e"][x] + m["p"][: len(x)]
        q = s[-1] @ m["q"] * lm.WIDTH ** -0.5
        a = np.exp(s @ m["k"] @ q)
        o = (a / a.sum()) @ (s @ m["v"]) @ m["o"] + s[-1]
        z = np.maximum(o @ m["w"] + m["a"], 0) @ m["u"] + m["b"]
        target = row[lm.CONTEXT + 1 + j]
        total += z[table.of_class[target]] - np.log(np.exp(z).sum()) + table.within[target]
    return total


def random_model(seed=1):
    rng = np.random.default_rng(seed)
    counts = np.floor(rng.pareto(1, 257) * 20)
    table = lm.id_table(counts, [bytes([i]) for i in range(256)])
    return {n: v + rng.normal(size=v.shape).astype(np.float32) * 0.2 for n, v in lm.start(table).items()}, table


def test_batches_score_as_plain_attention():
    model, table = random_model()
    texts = ["", "a b", "word " * 40, "x" * 500]
    dictionary, numbers, counts = lm.words_of(texts)
    pieces = [np.frombuffer((" " + w).encode(), dtype=np.uint8) for w in dictionary.to_pylist()]

    stored = {"n_ids": [len(p) for p in pieces], "words": numbers, "n_words": counts, "pieces": np.concatenate(pieces)}
    block = lm.Block.of(SimpleNamespace(**{n: lm.as_bytes(v) for n, v in stored.items()}))
    ids, first, document, scored = lm.sequences(block, 256)
    got = np.bincount(document, weights=lm.Scorer(model, table).score(ids, first, scored))
    want = [plain_score(model, table, list("".join(" " + w for w in words(t)).encode()), 256) for t in texts]
    assert np.allclose(got, want, rtol=1e-4)
    assert np.bincount(document, weights=scored).tolist() == [len("".join(" " + w for w in words(t))) + 1 for t in texts]


def test_words_encoded_together_as_each_for_itself():
    pytest.importorskip("tiktoken")
    from sieveflow.llm.queries import MULTILINGUAL_RANKS, PATTERN, byte_pairs
    from sieveflow.llm.token_files import read_ranks
    encode = byte_pairs(read_ranks(MULTILINGUAL_RANKS), PATTERN).load()
    some = ["the", "don't", "'s", "x=1;", "été", "日本", "a1b2", "...", "$$", "ﬁ", "", "e\u0301", "😀‍"]
    for words in (some, ["a\u00a0b", "\u2003", *some], []):
        ids, counts = encode(words)
        each = [encode([w]) for w in words]
        assert ids.tolist() == [i for e, _ in each for i in e.tolist()]
        assert counts.tolist() == [len(e) for e, _ in each]


def test_large_weights_stay_finite():
    model, table = random_model(7)
    model = {n: v * 40 for n, v in model.items()}
    row = np.random.default_rng(1).integers(0, 257, 4 * lm.STRIDE + lm.WINDOW + 1)
    assert np.isfinite(lm.Scorer(model, table).score(row, np.arange(4) * lm.STRIDE, np.full(4, lm.STRIDE))).all()


def test_probabilities_add_up():
    model, table = random_model(3)
    row = np.full(lm.WINDOW + 1, 256)
    row[1: lm.CONTEXT + 1] = 97
    every = np.stack([np.append(row[: lm.CONTEXT + 1], [i] + [256] * lm.STRIDE) for i in range(257)])
    scores = lm.Scorer(model, table).score(every.ravel(), np.arange(257) * every.shape[1], np.ones(257, dtype=int))
    assert abs(np.exp(scores).sum() - 1) < 1e-4


def test_gradient():
    model, _ = random_model(5)
    model = {n: v.astype(np.float64) for n, v in model.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 300, (4, lm.WINDOW)), rng.integers(0, lm.CLASSES, (4, lm.STRIDE))
    w = (rng.random((4, lm.STRIDE)) < 0.8).astype(float)
    _, g = lm.gradient(model, x, y, w)
    for n, v in model.items():
        at = tuple(rng.integers(0, s) for s in v.shape) if n != "e" else (x[1, 5], 3)
        old, losses = v[at], []
        for step in (1e-5, -1e-5):
            v[at] = old + step
            losses.append(lm.gradient(model, x, y, w)[0])
        v[at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - g[n][at]) < 1e-7


def test_gradient_out_of_range(monkeypatch):
    """Where exponentials leave their range, rows are shifted; the gradient is that of rows that are not."""
    model, _ = random_model(5)
    rng = np.random.default_rng(3)
    x, y, w = rng.integers(0, 300, (4, lm.WINDOW)), rng.integers(0, lm.CLASSES, (4, lm.STRIDE)), np.ones((4, lm.STRIDE))
    loss, g = lm.gradient({n: v.astype(np.float64) for n, v in model.items()}, x, y, w)
    large = lm.gradient({n: v * 40 for n, v in model.items()}, x, y, w)
    assert np.isfinite(large[0]) and all(np.isfinite(v).all() for v in large[1].values())
    monkeypatch.setattr(lm, "_in_range", lambda sums: False)
    shifted = lm.gradient({n: v.astype(np.float64) for n, v in model.items()}, x, y, w)
    assert abs(shifted[0] - loss) < 1e-12 and all(np.allclose(shifted[1][n], v, rtol=1e-9, atol=1e-15) for n, v in g.items())


def test_steps_leave_what_the_batch_has_not():
    """A step moves the vectors of the batch's ids only, and no vector's one."""
    model, _ = random_model(5)
    adam, rng = lm.Adam(model), np.random.default_rng(3)
    before = adam.slots.copy()
    x = rng.integers(0, 300, (4, lm.WINDOW))
    adam.learn(x, rng.integers(0, lm.CLASSES, (4, lm.STRIDE)), np.ones((4, lm.STRIDE), np.float32))
    moved = (adam.slots != before).any(axis=1)
    assert set(np.flatnonzero(moved)) == set(x.ravel()) and (adam.slots[:, -1] == 1).all()
    assert adam.model["e"].base is adam.slots and lm.packed(adam.model).size == sum(math.prod(s) for s in lm.SHAPES.values())


@pytest.mark.parametrize("block_bytes, frequent", [(200, 0), (200, 6), (200, 1000), (8 << 20, 6)])
def test_base_and_odd_rows(spark, monkeypatch, block_bytes, frequent):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "LEAST_STEPS", 2)
    rows = [*ODD, (30, "x " * 20_000 + "A b  ", "en", "a", 1), *((100 + i, f"The word {i % 7} and " * 9, "en", "a", 1) for i in range(40))]
    got = log_probabilities(odd_docs(spark, True, rows).repartition(3), characters()).collect()
    same_base(got, [r[:2] for r in rows])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    copies = {r.score for r in got if r.doc_id == 1}
    assert len(copies) == 1 or max(copies) - min(copies) < 1e-3
    assert {r.n_ids for r in got if r.doc_id in (3, 4, 6)} == {1}


def test_empty_and_nothing_to_learn_from(spark):
    assert rows_of(log_probabilities(empty_docs(spark), characters())) == []
    rows = [(None, "a b", "en", "a", 3), (next(i for i in range(99) if held(i)), "c", "en", "a", 1)]
    got = log_probabilities(odd_docs(spark, False, rows), characters()).collect()
    same_base(got, [r[:2] for r in rows])
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_learns_what_follows(spark, monkeypatch):
    """Held-out texts whose letters depend on the one before are likelier than by counts alone."""
    monkeypatch.setattr(lm, "SHARE", 3)
    rng = np.random.default_rng(4)
    after = {c: rng.permutation(list("abcdefghijklmnop"))[:2] for c in "abcdefghijklmnop"}

    def text():
        out = "a"
        for _ in range(200):
            out += rng.choice(after[out[-1]])
        return out

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string").repartition(3)
    got = [r for r in log_probabilities(docs, characters()).collect() if r.held_out]
    per_id = sum(r.score for r in got) / sum(r.n_ids for r in got)
    assert per_id > -0.55  # log10(1/2) is -0.30, by counts alone about -1.2


def test_every_window_is_learned_from(spark, monkeypatch):
    """Each block is dealt to one round, and a task takes steps over all scored ids of its blocks."""
    model, table = random_model()
    seen, backward = [], lm._backward
    monkeypatch.setattr(lm, "_backward", lambda m, x, target, weight: (seen.append(int(weight.sum())), backward(m, x, target, weight))[1])
    row = np.random.default_rng(2).integers(0, 257, 5000 * lm.STRIDE + lm.WINDOW + 1)
    parts = [(row, np.arange(a, b) * lm.STRIDE, np.full(b - a, lm.STRIDE)) for a, b in ((0, 3500), (3500, 3500), (3500, 5000))]
    assert lm.train(model, table, iter(parts))[1] == 5000
    assert sum(seen) == 5000 * lm.STRIDE
    blocks = [(p << 32) + i for p in range(5) for i in range(7)]
    assert sorted(b for r in range(lm.SHARE) for b in blocks if b % lm.SHARE == r) == blocks


def test_learns_from_few_texts(spark):
    """120 texts in which one word always follows another: what every 128th window showed was not enough."""
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["red fox", "old elm", "sly cat"], 40))) for i in range(120)], "doc_id long, text string").repartition(2)
    got = [r for r in log_probabilities(docs, characters()).collect() if r.held_out]
    per_id = sum(r.score for r in got) / sum(r.n_ids for r in got)
    assert per_id > -0.2  # log10(1/3) for eight ids is -0.06, it was below -1 before


def test_stored_blocks_are_pages_of_their_own(spark, monkeypatch, tmp_path):
    """Executors keep buffers of the largest page outside their heap: a task's blocks were one page."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 200)
    monkeypatch.setattr(common, "shared_folder", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    docs = spark.createDataFrame([(i, f"The word {i % 7} and " * 9) for i in range(40)], "doc_id long, text string").coalesce(1)
    assert log_probabilities(docs, characters()).count() == 40
    parquet, path = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop.fs.Path
    (file,) = tmp_path.glob("lm-*/1/*.parquet")
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path(str(file)), spark._jsc.hadoopConfiguration()))
    try:
        (group,) = reader.getFooter().getBlocks()
        assert group.getRowCount() > 10
        pages = {c.getPath().toDotString(): reader.readOffsetIndex(c).getPageCount() for c in group.getColumns()}
    finally:
        reader.close()
    assert set(pages.values()) == {group.getRowCount()}, pages
