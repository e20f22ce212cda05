"""Log probabilities of texts: a causal self-attention model over subword ids, and word counts as the base.

1. **Blocks.** Texts are read once, lower-cased (A-Z) and cut into words, and written as blocks of about `BLOCK_BYTES`: a dictionary
   of the block's different words with their subword ids and training counts, and each document as numbers of that dictionary.
2. **Counts.** Words (as 64-bit hashes) are counted over all training documents: blocks contribute each word once, so a word that is
   everywhere is one row a block. The counts of at most `FREQUENT` words (all from some count on) travel with the tasks. For
   other words a document is scored as if its block were the corpus, and a join of their (word, document) pairs with the
   counts gives what that is off by, summed by document. Subword ids are counted too; their table has the vocabulary's size.
3. **Model.** Single-head causal attention over windows of `WINDOW` ids, then one hidden layer, gives the probability of the next
   id's class; ids within a class go by their counts in all training documents. Frequent ids are classes of their own, the rest
   are cut from the alphabetical list, so that a class holds ids that begin alike. Blocks are dealt to `SHARE` rounds, and every
   training window is learned from in one of them. Every task trains in numpy (Adam, masked batches) block after block, from the
   start that the round before left; results are averaged by their windows in a tree. What is sent per task is the model's size.
4. **Scores.** Windows overlap by `CONTEXT` ids and each scores only what the one before did not, so each id is scored once with
   at least that much context; batches of windows of many documents go through masked attention together. The first window
   of a document is preceded by end ids.

The model's probabilities are normalised over all ids and the end, so `score` is the log10 probability of the text's ids.

Defined results: a NULL text counts as empty and is scored by its end alone. A NULL id has no remainder: it is not held out and not
learned from. Without training documents all counts are zero and the model knows nothing but its classes. Repeated rows are
scored alike. Very long texts are blocks of their own. An empty table gives an empty table; other columns are ignored. Scores depend
somewhat on how the input is split, as tasks train on what they read; training amplifies rounding, too.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import A_ROW_A_PAGE, Scratch, arrow_rows

WINDOW = 24
CONTEXT = 6
STRIDE = WINDOW - CONTEXT
WIDTH = 16          # numbers per id
HIDDEN = 16
CLASSES = 128
ALONE = 96          # ids that are classes of their own
OWN_SLOTS = 3072    # ids with an input vector of their own
SLOTS = 4096
SHARE = 3           # rounds that share the blocks, so that each is trained on once
LEAST_STEPS = 48    # of a task in a round, over its windows again and again
BATCH = 64          # windows of a training step
SCORED = 64         # windows scored together, so that they stay in the cache
RATE = 0.015
BLOCK_BYTES = 2 << 20
FAN_IN = 16
FREQUENT = 1 << 17  # words whose counts travel with the tasks, 16 bytes each
TEXTS = 250         # texts, and blocks, that Python gets at a time
BLOCKS = 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


# -- blocks -----------------------------------------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """A given subword encoder: `load`, called in the task, gives a function from words to all their ids and the ids per word."""

    load: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]]
    end: int              # the first number that is no id
    spelled: list[bytes]  # of each id


def _once(kept, make):
    """What `make` gives, made once by each Python worker: a broadcast value stays with it between tasks.

    Functions are sent anew with each task, and what they made would pile up until Python happens to collect its garbage.
    """
    if "made" not in kept.value:
        kept.value["made"] = make()
    return kept.value["made"]


def _reused() -> None:
    """What numpy frees stays with the process, up to a few MB: glibc returns arrays of more than 128 KB to the system, which gives them
    back page by page, until one of this size has been freed."""
    np.empty(2 << 20, dtype=np.uint8)


def words_of(texts):
    """(dictionary, numbers, counts): different words, every word as its number, words of each text."""
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = pc.ascii_lower(pc.fill_null(pa.array(texts, pa.large_string()), ""))
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty piece
    some_at = some.to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy()
    counts = np.diff(np.concatenate(([0], np.cumsum(some_at)))[offsets - offsets[0]])
    coded = words.filter(some).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), counts


# numbers that only Python reads are bytes: Spark passes them on as they are
BLOCK_COLUMNS = "train binary, n_words binary, words binary, h array<long>, n_train array<int>, n_ids binary, pieces binary"
PLANES = 4  # bytes of a number, lowest first


def as_bytes(numbers) -> bytes:
    """Numbers as one run of bytes per plane, which Parquet packs better than whole numbers."""
    return np.ascontiguousarray(np.asarray(numbers).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :PLANES].T).tobytes()


def as_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(PLANES, -1)
    numbers = planes[0].astype(np.int32)
    for i in range(1, PLANES):
        numbers |= planes[i].astype(np.int32) << 8 * i
    return numbers


@dataclass
class Block:
    """The numbers of one block: of each document its words, of each different word its ids."""

    train: np.ndarray
    n_words: np.ndarray
    words: np.ndarray
    n_ids: np.ndarray
    pieces: np.ndarray

    @classmethod
    def of(cls, row) -> Block:
        return cls(*(as_numbers(getattr(row, n)) if hasattr(row, n) else None for n in ("train", "n_words", "words", "n_ids", "pieces")))


def _blocks(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    load, kept = vocabulary.load, docs.sparkSession.sparkContext.broadcast({})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        from pyspark import TaskContext
        encode = _once(kept, load)
        number = TaskContext.get().partitionId() << 32

        def block(ids: list, train: list, texts: list) -> pd.DataFrame:
            dictionary, numbers, counts = words_of(texts)
            learned = np.repeat(np.array(train, dtype=bool), counts)
            names = dictionary.to_numpy(zero_copy_only=False).tolist()
            pieces, n_ids = encode(names)
            h = np.array([xxhash.xxh3_64_intdigest(w) for w in names], dtype=np.uint64).view(np.int64)
            numbered = {"train": train, "n_words": counts, "words": numbers, "n_ids": n_ids, "pieces": pieces}
            return pd.DataFrame({"block": [number], "ids": [ids], "h": [h], "n_train": [np.bincount(numbers[learned], minlength=len(names)).astype(np.int32)]}
                                | {c: [as_bytes(v)] for c, v in numbered.items()})

        ids, train, texts, size = [], [], [], 0
        for b in batches:
            for i, t, text in zip(b["id"].tolist(), b["train"].tolist(), b["text"]):
                ids.append(i)
                train.append(t)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield block(ids, train, texts)
                    number, ids, train, texts, size = number + 1, [], [], [], 0
        if ids:
            yield block(ids, train, texts)

    learned = F.col(f"`{id_col}`").isNotNull() & ~held_out(F.col(f"`{id_col}`"))
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), learned.alias("train"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).mapInPandas(run, f"block long, ids array<{id_type}>, {BLOCK_COLUMNS}")


def sequences(block: Block, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first, document, scored) of a block: all documents' ids in one row, each behind CONTEXT + 1 ends and with one at its end,
    filled up to whole windows; the place, the document and the number of scored ids of each window."""
    n_ids, words = block.n_ids.astype(np.int64), block.words
    per_word = n_ids[words]
    total = int(per_word.sum())
    starts = np.cumsum(n_ids) - n_ids
    # from the place of an id in the texts to its place in the dictionary's ids
    shift = (starts[words] - (np.cumsum(per_word) - per_word)).astype(np.int32)
    ids = block.pieces[np.repeat(shift, per_word) + np.arange(total, dtype=np.int32)] if total else np.zeros(0, np.int32)
    bounds = np.concatenate(([0], np.cumsum(block.n_words.astype(np.int64))))
    upto = np.concatenate(([0], np.cumsum(per_word)))[bounds]
    length = np.diff(upto)
    n_windows = (length + STRIDE) // STRIDE  # the end is scored too
    room = CONTEXT + 1 + n_windows * STRIDE
    at = np.cumsum(room) - room
    out = np.full(int(room.sum()) + WINDOW, end, dtype=np.int32)
    out[np.repeat((at + CONTEXT + 1 - upto[:-1]).astype(np.int32), length) + np.arange(total, dtype=np.int32)] = ids
    document = np.repeat(np.arange(len(length)), n_windows)
    k = np.arange(len(document)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    scored = np.minimum(STRIDE, (length + 1)[document] - k * STRIDE)
    return out, at[document] + k * STRIDE, document, scored


# -- the model --------------------------------------------------------------------------------------------------------

SHAPES = {"e": (SLOTS, WIDTH), "p": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH),
          "w": (WIDTH, HIDDEN), "a": (HIDDEN,), "u": (HIDDEN, CLASSES), "b": (CLASSES,)}
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))[CONTEXT:]
REACH = np.arange(WINDOW)
AHEAD = np.arange(CONTEXT + 1, WINDOW + 1)


@dataclass
class Table:
    """What the corpus' counts say of each id: input slot, class, and log probability within its class."""

    slot: np.ndarray
    of_class: np.ndarray
    within: np.ndarray
    class_count: np.ndarray


def id_table(counts: np.ndarray, spelled: list[bytes]) -> Table:
    """`counts` of all ids and, last, of the end."""
    n = len(counts)
    ranked = np.lexsort((np.arange(n), -counts))
    slot = OWN_SLOTS + np.arange(n) % (SLOTS - OWN_SLOTS)
    slot[ranked[:OWN_SLOTS]] = np.arange(min(OWN_SLOTS, n))
    of_class = np.full(n, -1)
    alone = [n - 1, *ranked[ranked != n - 1][: ALONE - 1].tolist()]
    of_class[alone] = np.arange(len(alone))
    rest = sorted(np.flatnonzero(of_class < 0).tolist(), key=lambda i: spelled[i])
    mass = np.cumsum(np.sqrt(counts[rest] + 0.5))
    if rest:
        of_class[rest] = ALONE + np.minimum((mass * (CLASSES - ALONE) / mass[-1] * (1 - 1e-12)).astype(np.int64), CLASSES - ALONE - 1)
    smooth = counts + 0.5
    total = np.bincount(of_class, weights=smooth, minlength=CLASSES)
    return Table(slot, of_class, np.log(smooth / total[of_class]), total)


def start(table: Table) -> dict[str, np.ndarray]:
    """Parameters before training: classes have the probabilities of their counts."""
    rng = np.random.default_rng(11)
    model = {n: (rng.normal(size=s) * (0.1 if n in "ep" else s[0] ** -0.5)).astype(np.float32) for n, s in SHAPES.items()}
    model["a"][:] = 0
    model["u"] *= 0.1
    held = table.class_count > 0
    model["b"][:] = -30  # a class without ids
    model["b"][held] = np.log(table.class_count[held] / table.class_count.sum())
    return model


def _with_ones(table: np.ndarray) -> np.ndarray:
    """A column of ones beside `table`: in products it carries what is added and adds up weights."""
    return np.column_stack((table, np.ones(len(table), table.dtype)))


def _wider(table: np.ndarray, below=0) -> np.ndarray:
    """`table` with a column for the ones, and the row `below` if there is one."""
    out = np.zeros((len(table) + (below is not None), table.shape[1] + 1), table.dtype)
    out[: len(table), :-1] = table
    if below is not None:
        out[-1, :-1] = below
    return out


def _spread(numbers: np.ndarray) -> np.ndarray:
    """A number per row in all columns: rows are so short that numpy is slow at scaling each by its number."""
    return numbers.repeat(WIDTH + 1).reshape(-1, WIDTH + 1)


def _in_range(sums: np.ndarray) -> bool:
    return 1e-25 < sums.min() <= sums.max() < 1e25


def _shifted(values: np.ndarray, counted=1) -> np.ndarray:
    """exp of rows that leave the range otherwise, up to a factor per row; 0 for what is not counted."""
    values = np.where(counted, values, -np.inf)
    values -= values.max(axis=-1, keepdims=True)
    return np.exp(values, out=values)


def _backward(model: dict, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Probabilities of the scored ids of a batch of windows, the gradient of their mean loss, and that of each place's input vector in
    place of `e` (and one column more); `slots` of the model is `e` with its ones.

    Query and key are one product, value, output and hidden layer another; all rows have WIDTH + 1 numbers, the hidden ones too.
    """
    m, n, slots = model, len(x), model["slots"]
    query, out_of, shown = m["q"] * WIDTH ** -0.5, m["v"] @ m["o"], m["o"] @ m["w"]
    asked, beside, back = _wider(query @ m["k"].T), _wider(m["w"]), _wider(m["v"] @ shown)
    down, up = _wider(m["v"] @ shown, m["a"]), np.concatenate((m["u"], m["b"][None]))
    down[-1, -1] = 1  # hidden rows keep a one
    s = slots.take(x, axis=0, mode="clip")
    s += _wider(m["p"], None)
    s_t, last = s.transpose(0, 2, 1), s[:, CONTEXT:].reshape(-1, WIDTH + 1)
    q = (last @ asked).reshape(n, STRIDE, -1)
    with np.errstate(all="ignore"):
        att = np.matmul(q, s_t)
        np.exp(att, out=att)
        att *= CAUSAL
        mixed = np.matmul(att, s)  # its last column is the sum of weights
        if not _in_range(mixed[:, :, WIDTH]):
            att = _shifted(np.matmul(q, s_t), CAUSAL)
            mixed = np.matmul(att, s)
        mixed = mixed.reshape(-1, WIDTH + 1)
        share = _spread(1 / mixed[:, WIDTH])
        mixed *= share
        h = mixed @ down
        h += last @ beside
        np.maximum(h, 0, out=h)
        z = h @ up
        np.exp(z, out=z)
        total = z @ np.ones(CLASSES, z.dtype)
        if not _in_range(total):
            z = _shifted(h @ up)
            total = z @ np.ones(CLASSES, z.dtype)
    at = np.arange(0, z.size, CLASSES) + target.ravel()
    likely = z.take(at)
    z.put(at, likely - total)
    scale = _spread((weight / max(1.0, weight.sum())).astype(z.dtype).ravel() / total)
    g_up = z.T @ (h * scale)
    g = {"u": g_up[:, :-1].T, "b": g_up[:, -1]}
    scale *= h > 0
    dh = z @ np.concatenate((m["u"], np.zeros((1, CLASSES), z.dtype))).T
    dh *= scale
    g_down = mixed.T @ dh
    g_mixed = g_down[:-1, :-1]
    g["w"], g["a"] = (last.T @ dh)[:-1, :-1] + out_of.T @ g_mixed, g_down[-1, :-1]
    g["v"], g["o"] = g_mixed @ shown.T, m["v"].T @ g_mixed @ m["w"].T
    d = dh @ back.T
    d *= share
    d[:, WIDTH] = -((d * mixed) @ np.ones(WIDTH + 1, d.dtype))
    d = d.reshape(n, STRIDE, -1)
    datt = np.matmul(d, s_t)
    datt *= att
    dq = np.matmul(datt, s).reshape(-1, WIDTH + 1)
    ds = np.matmul(att.transpose(0, 2, 1), d)
    ds += np.matmul(datt.transpose(0, 2, 1), q)
    late = dh @ beside.T
    late += dq @ asked.T
    ds[:, CONTEXT:] += late.reshape(n, STRIDE, -1)
    g_asked = (last.T @ dq)[:-1, :-1]
    g["q"], g["k"] = g_asked @ m["k"] * WIDTH ** -0.5, g_asked.T @ query
    g["p"] = (np.ones(n, ds.dtype) @ ds.reshape(n, -1)).reshape(WINDOW, -1)[:, :-1]
    return likely / total, g, ds


def gradient(model: dict, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of the scored ids of a batch of windows, and its gradient."""
    likely, g, ds = _backward(model | {"slots": _with_ones(model["e"])}, x, target, weight)
    g["e"] = np.zeros_like(model["e"])
    np.add.at(g["e"], x.ravel(), ds.reshape(-1, WIDTH + 1)[:, :-1])
    loss = np.log(np.maximum(likely, np.finfo(np.float32).tiny)) * weight.ravel()
    return -float(loss.sum() / max(1.0, weight.sum())), g


class Adam:
    """Steps of one task. Input vectors take a step where the batch has them, all other numbers lie in one row."""

    def __init__(self, model: dict):
        self.step, self.names = 0, [n for n in SHAPES if n != "e"]
        self.slots = _with_ones(model["e"].astype(np.float32))
        self.rest = np.concatenate([model[n].ravel() for n in self.names]).astype(np.float32)
        self.model, at = {"e": self.slots[:, :-1], "slots": self.slots}, 0
        for n in self.names:
            size = math.prod(SHAPES[n])
            self.model[n] = self.rest[at: at + size].reshape(SHAPES[n])
            at += size
        self.moments = [np.zeros_like(a) for a in (self.slots, self.slots, self.rest, self.rest)]

    def learn(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> None:
        _, g, ds = _backward(self.model, x, target, weight)
        self.step += 1
        # shorter steps the longer a task goes on, so that tasks end near each other
        size = RATE * math.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step) / math.sqrt(1 + self.step / LEAST_STEPS)
        slots = x.ravel()
        order = np.argsort(slots.astype(np.int16), kind="stable")  # slots fit, and 16 bits are sorted by their digits
        slots = slots.take(order)
        begins = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1])))
        met = slots.take(begins)
        summed = np.add.reduceat(ds.reshape(-1, WIDTH + 1).take(order, axis=0), begins, axis=0)
        summed[:, WIDTH] = 0  # ones stay
        first, second = (a.take(met, axis=0) for a in self.moments[:2])
        self.slots[met] -= self._step(summed, first, second, size)
        self.moments[0][met], self.moments[1][met] = first, second
        self.rest -= self._step(np.concatenate([g[n].ravel() for n in self.names]), *self.moments[2:], size)

    @staticmethod
    def _step(d: np.ndarray, first: np.ndarray, second: np.ndarray, size: float) -> np.ndarray:
        """The step, written over the gradient `d`."""
        first *= 0.9
        first += 0.1 * d
        second *= 0.99
        d *= d
        d *= 0.01
        second += d
        np.sqrt(second, out=d)
        d += 1e-6
        np.divide(first, d, out=d)
        d *= size
        return d


class Scorer:
    """The model with all that depends on one id only worked out beforehand."""

    def __init__(self, model: dict, table: Table):
        m = {n: v.astype(np.float32) for n, v in model.items()}
        to_hidden = m["v"] @ m["o"] @ m["w"]
        self.tables = []
        for t, b in ((m["q"] * WIDTH ** -0.5, 0), (m["k"], 0), (to_hidden, 0), (m["w"], m["a"])):
            self.tables.append(((m["e"] @ t).astype(np.float32), (m["p"] @ t + b).astype(np.float32)))
        # a column of ones adds up the attention weights and, over their sum, carries what is added to the classes
        (tv, pv), (tx, px) = self.tables[2:]
        self.tables[2:] = (_with_ones(tv), _wider(pv, None)), (_wider(tx, None), _wider(px, None))
        self.up = np.concatenate((m["u"], m["b"][None]))
        self.table = Table(table.slot.astype(np.int32), table.of_class.astype(np.int32), table.within.astype(np.float32), table.class_count)

    def score(self, ids: np.ndarray, first: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Natural log probability of each window's scored ids."""
        slots, classes, within = self.table.slot[ids], self.table.of_class[ids], self.table.within[ids]
        out, places = np.empty(len(first)), np.arange(STRIDE)
        with np.errstate(all="ignore"):
            for a in range(0, len(first), SCORED):
                f = first[a: a + SCORED, None]
                x, ahead = slots.take(f + REACH), f + AHEAD
                target = classes.take(ahead)
                hit = self._batch(x, target, False)
                if not np.isfinite(hit).all():  # exponentials left their range
                    hit = self._batch(x, target, True)
                hit += within.take(ahead)
                hit *= places < scored[a: a + SCORED, None]
                out[a: a + SCORED] = hit @ np.ones(STRIDE)
        return out

    def _batch(self, x: np.ndarray, target: np.ndarray, shifted: bool) -> np.ndarray:
        """Log probability of each target's class; `shifted` takes the greatest value off before exponentials."""
        (tq, pq), (tk, pk), (tv, pv), (tx, px) = self.tables
        late = x[:, CONTEXT:]
        q, k, v, h = (t.take(i, axis=0, mode="clip") for t, i in ((tq, late), (tk, x), (tv, x), (tx, late)))
        q += pq[CONTEXT:]
        k += pk
        v += pv
        att = np.matmul(q, k.transpose(0, 2, 1))
        if shifted:
            att = _shifted(att, CAUSAL)
        else:
            np.exp(att, out=att)
            att *= CAUSAL
        mixed = np.matmul(att, v).reshape(-1, HIDDEN + 1)
        mixed *= _spread(1 / mixed[:, HIDDEN])
        h += px[CONTEXT:]
        h = h.reshape(-1, HIDDEN + 1)
        h += mixed
        np.maximum(h, 0, out=h)
        z = h @ self.up
        if shifted:
            z -= z.max(axis=1, keepdims=True)
        hit = z.take(np.arange(0, z.size, CLASSES) + target.ravel()).astype(np.float64)
        np.exp(z, out=z)
        hit -= np.log(z @ np.ones(CLASSES, z.dtype))
        return hit.reshape(late.shape)


def packed(model: dict) -> np.ndarray:
    return np.concatenate([model[n].ravel() for n in SHAPES]).astype(np.float32)


def unpacked(numbers: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n, s in SHAPES.items():
        size = math.prod(s)
        out[n] = np.array(numbers[at: at + size], dtype=np.float32).reshape(s)
        at += size
    return out


def train(model: dict, table: Table, blocks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[dict, int]:
    """One task's steps over all windows (ids, first, scored) of its blocks, a block's in an order drawn from their number; at least
    `LEAST_STEPS`. The model, and the number of windows."""
    adam, places, seen, few = Adam(model), np.arange(STRIDE), 0, []

    def steps(ids: np.ndarray, first: np.ndarray, scored: np.ndarray) -> None:
        order = np.random.default_rng(len(first)).permutation(len(first))
        slots, classes = table.slot[ids], table.of_class[ids]
        for a in range(0, len(first), BATCH):
            f, n = first[order[a: a + BATCH], None], scored[order[a: a + BATCH], None]
            adam.learn(slots.take(f + REACH), classes.take(f + AHEAD), (places < n).astype(np.float32))

    for windows in blocks:
        if len(windows[1]):
            steps(*windows)
            seen += len(windows[1])
            # blocks that may be gone over again; of more windows there are steps enough
            few = [*few, windows] if adam.step < LEAST_STEPS else []
    while few and adam.step < LEAST_STEPS:
        for windows in few:
            steps(*windows)
    return adam.model, seen


def _trained(blocks: DataFrame, model: dict, table: Table, end: int, round_no: int) -> dict | None:
    """The average of what all tasks made of `model`, weighed by their windows; each block is in one round of `SHARE`."""
    # the model's size at every size of the input
    sent = blocks.sparkSession.sparkContext.broadcast((packed(model), table.slot.astype(np.int32), table.of_class.astype(np.int32)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        _reused()
        before, slot, of_class = sent.value

        def windows():
            for batch in batches:
                for row in batch.itertuples():
                    block = Block.of(row)
                    ids, first, document, scored = sequences(block, end)
                    learned = np.flatnonzero(block.train[document])
                    yield ids, first[learned], scored[learned]

        after, n = train(unpacked(before), Table(slot, of_class, None, None), windows())
        if n:
            yield pd.DataFrame({"task": [TaskContext.get().partitionId()], "weight": [float(n)], "numbers": [packed(after)]})

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task")
        weight = group["weight"].to_numpy()
        numbers = sum(np.asarray(n, dtype=np.float64) * (w / weight.sum()) for n, w in zip(group["numbers"], weight))
        return pd.DataFrame({"task": [int(group["task"].iloc[0]) // FAN_IN], "weight": [weight.sum()], "numbers": [numbers.astype(np.float32)]})

    schema = "task long, weight double, numbers array<float>"
    scratch = Scratch(blocks.sparkSession, "attention")
    dealt = blocks.where(F.pmod(F.col("block"), F.lit(SHARE)) == round_no)
    done = scratch.store(dealt.select("train", "n_words", "words", "n_ids", "pieces").mapInPandas(run, schema))
    while (n := done.count()) > 1:
        # tasks of equal task // FAN_IN meet, until one row is left
        number = F.col("task") if n <= FAN_IN else F.floor(F.col("task") / FAN_IN)
        number = F.lit(0).cast("long") if n <= FAN_IN else number
        done = scratch.store(done.withColumn("g", number).groupBy("g").applyInPandas(lambda g: merged(g.drop(columns="g")), schema))
    last = done.first()
    return unpacked(np.array(last.numbers, dtype=np.float32)) if last else None


# -- Spark ------------------------------------------------------------------------------------------------------------


def _id_counts(blocks: DataFrame, end: int) -> np.ndarray:
    """How often each id, and last the end, stands in training documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = Block.of(row)
                n = np.bincount(block.pieces, weights=np.repeat(np.asarray(row.n_train), block.n_ids), minlength=end + 1)
                n[end] = np.count_nonzero(block.train)
                used = np.flatnonzero(n)
                yield pd.DataFrame({"i": used, "n": n[used].astype(np.int64)})

    counts = np.zeros(end + 1)
    # at most as many rows as the vocabulary has ids
    for r in blocks.select("train", "n_train", "n_ids", "pieces").mapInPandas(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        counts[r.i] = r.n
    return counts


def log_probabilities(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids."""
    scratch = Scratch(docs.sparkSession, "lm")
    id_type = docs.schema[id_col].dataType.simpleString()
    with arrow_rows(docs.sparkSession, TEXTS):
        blocks = scratch.store(_blocks(docs, vocabulary, id_col, text_col), **A_ROW_A_PAGE)
    with arrow_rows(docs.sparkSession, BLOCKS):
        return _scored(blocks, vocabulary, id_type, scratch)


def _scored(blocks: DataFrame, vocabulary: Vocabulary, id_type: str, scratch: Scratch) -> DataFrame:
    end = vocabulary.end
    words = blocks.select(F.explode(F.arrays_zip("h", "n_train")).alias("w")).select("w.h", "w.n_train")
    counts = scratch.store(words.where("n_train > 0").groupBy("h").agg(F.sum(F.col("n_train").cast("long")).alias("c")))
    n_words, n_different = counts.agg(F.sum("c"), F.count("*")).first()
    table_counts = _id_counts(blocks, end)
    ends = int(table_counts[end])
    n_train = (n_words or 0) + ends
    total = n_train + 0.5 * (n_different + (ends > 0) + 1)
    table = id_table(table_counts, vocabulary.spelled)
    model = start(table)
    for i in range(SHARE if n_train else 0):
        model = _trained(blocks, model, table, end, i) or model
    least = _least_frequent(counts)
    frequent = sorted((r.h, r.c) for r in counts.where(F.col("c") >= least).collect())  # FREQUENT at most
    known_h, known_c = (np.array([f[i] for f in frequent], dtype=np.int64) for i in (0, 1))

    sent = blocks.sparkSession.sparkContext.broadcast((known_h, known_c, packed(model), table.slot, table.of_class, table.within, table.class_count))
    kept = blocks.sparkSession.sparkContext.broadcast({})

    def looked_up(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counts of frequent words, the block's own for others; and which are frequent."""
        known_h, known_c = sent.value[:2]
        if not len(known_h):
            return own, np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(known_h, h), len(known_h) - 1)
        met = known_h[at] == h
        return np.where(met, known_c[at], own), met

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _once(kept, lambda: Scorer(unpacked(sent.value[2]), Table(*sent.value[3:])))
        for batch in batches:
            for row in batch.itertuples():
                c, _ = looked_up(np.asarray(row.h), np.asarray(row.n_train))
                block = Block.of(row)
                n = block.n_words.astype(np.int64)
                of, at = np.repeat(np.arange(len(n)), n), block.words
                base = np.bincount(of, weights=np.log10((c + 0.5) / total)[at], minlength=len(n)) + math.log10((ends + 0.5) / total)
                known = np.bincount(of, weights=(c > 0)[at], minlength=len(n)).astype(np.int64) + (ends > 0)
                ids, first, document, scored = sequences(block, end)
                value = np.bincount(document, weights=scorer.score(ids, first, scored), minlength=len(n)) / math.log(10)
                yield pd.DataFrame({
                    "block": row.block, "d": np.arange(len(n)), "doc_id": pd.Series(list(row.ids), dtype=object), "n_tokens": n + 1, "known": known,
                    "base": base, "score": value, "n_ids": np.bincount(document, weights=scored, minlength=len(n)).astype(np.int64)})

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                h, own, block = np.asarray(row.h), np.asarray(row.n_train), Block.of(row)
                at, n_docs = block.words, len(block.n_words)
                of = np.repeat(np.arange(n_docs), block.n_words)
                here = ~looked_up(h, own)[1][at]
                pairs, n = np.unique(at[here].astype(np.int64) * n_docs + of[here], return_counts=True)
                word = pairs // max(1, n_docs)
                yield pd.DataFrame({"block": [row.block], "h": [h[word]], "own": [own[word]], "d": [pairs % max(1, n_docs)], "n": [n]})

    pairs = blocks.select("block", "n_words", "words", "h", "n_train").mapInPandas(
        rare, "block long, h array<long>, own array<int>, d array<int>, n array<int>").select(
        "block", F.explode(F.arrays_zip("h", "own", "d", "n")).alias("p")).select("block", "p.*")
    off = pairs.join(counts.where(F.col("c") < least).withColumnRenamed("h", "ch"), (F.col("h") == F.col("ch")) & (F.col("c") > F.col("own"))).groupBy(
        F.col("block").alias("ob"), F.col("d").alias("od")).agg(
        F.sum(F.col("n") * (F.log10(F.col("c") + 0.5) - F.log10(F.col("own") + 0.5))).alias("more"),
        F.sum(F.when(F.col("own") == 0, F.col("n")).otherwise(0)).alias("more_known"))
    scored = blocks.mapInPandas(score, f"block long, d int, doc_id {id_type}, n_tokens long, known long, base double, score double, n_ids long")
    joined = scored.join(off, (F.col("block") == F.col("ob")) & (F.col("d") == F.col("od")), "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", "n_ids")
    return scratch.store(joined)


def _least_frequent(counts: DataFrame) -> int:
    """The least count of a frequent word: at most `FREQUENT` words have as many."""
    grade = F.floor(F.log2(F.col("c")) * 8)
    held = 0
    for r in counts.groupBy(grade.alias("g")).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("g")).collect():
        if held + r.n > FREQUENT:
            return last if held else 1 << 62
        held, last = held + r.n, r.least
    return 1
