"""SentencePiece encoding and decoding, with giant documents encoded in parallel.

The model at hand merges byte pairs, so the best path through the lattice of pieces is not one of
greatest score: it is the one path on which every two neighbouring pieces are *compatible*, that is, merging their
joined text gives back just these two. With weight 0 for a compatible step and -inf for
any other, that path is found by max-plus algebra all the same, and so can be cut anywhere:

1. A giant document is cut into chunks of `CHUNK` characters. The state at a cut is the last
   piece that ends at or before it. Each chunk yields its transfer matrix from the states at its
   left cut to those at its right one; inside a chunk every beginning of white space is a point
   that all paths share, so only the words at its ends (or a word longer than the chunk) need a search.
2. Matrices are combined in groups of `FAN` neighbours, level by level: a scan whose depth grows with the
   logarithm of the length, no group of which is larger than `FAN`.
3. Going down again, every group learns the states at its inner cuts, and each chunk is traced back
   on its own.

All other documents are one chunk and encoded where they are read; words seen before in a task are
looked up. Texts that occur more than once are cut and encoded once if they are giant.

Defined results: a NULL or empty text has no pieces. Characters without a piece become bytes. As
the model has it, U+2581 reads as a space, so decoding returns a space for it; everything else is returned
as it was. NULL ids and repeated rows stay, each with its pieces. An empty table gives an empty
table. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, small_batches

CHUNK = 1 << 15
FAN = 64
REMEMBERED = 100_000
MAX_MODEL_BYTES = 32 << 20
SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
NEVER = -np.inf

State = tuple[int, str]  # characters from the end of the last piece to the cut; that piece ("" where any will do)


def read_model(path: str) -> bytes:
    """The model file, checked: it travels with every task."""
    with open(path, "rb") as f:
        model = f.read()
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is {len(model)} bytes; a model travels with each task and may have {MAX_MODEL_BYTES}")
    return model


class Codec:
    """One model in one task."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.by_id = [sp.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.by_id) if i not in special}
        self.rank = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        if sp.normalize(" a  b\n") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b\n" or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("the model must keep text as it is and begin words with white space")
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if i in special else p.replace(SPACE, " ").encode()
                    for i, p in enumerate(self.by_id)]
        self.known: dict[str, list[int]] = {SPACE: [self.ids[SPACE]]}
        self.fits: dict[tuple[str, str], bool] = {}

    # ---- whole words

    def units(self, text: str) -> list[int]:
        """Ids of a text (after normalisation) that begins with white space: its words are independent."""
        words, known = UNIT.findall(text), self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                known[SPACE] = [self.ids[SPACE]]
                new = [w for w in dict.fromkeys(words) if w != SPACE]
            # the library puts one space in front itself
            known.update(zip(new, self.sp.encode([w[1:] for w in new], num_threads=1)))
        ids: list[int] = []
        for w in words:
            ids += known[w]
        return ids

    def encode(self, text: str) -> list[int]:
        return self.units(normal(text)) if text else []

    def decode(self, ids) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids])[1:].decode("utf-8", "replace")

    # ---- the lattice

    def merge(self, text: str) -> list[str]:
        """Byte-pair merges of a short text: best pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1], NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts
            parts[at: at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: str, b: str) -> bool:
        key = (a, b)
        if key not in self.fits:
            self.fits[key] = self.merge(a + b) == ([a, b] if a else [b])
        return self.fits[key]

    def from_(self, text: str, at: int) -> Iterator[str]:
        """Pieces that begin at a place; a character without a piece stands for itself."""
        for end in range(at + 1, min(len(text), at + self.longest) + 1):
            p = text[at:end]
            if p in self.ids:
                if self.compatible("", p):
                    yield p
            elif end == at + 1:
                yield p

    def to(self, text: str, at: int) -> Iterator[str]:
        """Pieces that end at a place."""
        for start in range(max(0, at - self.longest), at):
            p = text[start:at]
            if (p in self.ids and self.compatible("", p)) or (start == at - 1 and p not in self.ids):
                yield p


def normal(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


def is_cut(text: str, at: int) -> bool:
    """Whether a word begins here, which is a node of every path."""
    return at > 0 and at < len(text) and text[at] == SPACE and text[at - 1] != SPACE


@dataclass
class Chunk:
    """Characters [lo, hi) of a document's normal form, with `text` reaching `pad` further on both sides where there is more."""

    text: str
    lo: int    # places within `text`
    hi: int
    first: bool
    last: bool

    def entries(self, codec: Codec) -> list[State]:
        return [(0, "")] if self.first else self._states(codec, self.lo)

    def exits(self, codec: Codec) -> list[State]:
        return [(0, "")] if self.last else self._states(codec, self.hi)

    def _states(self, codec: Codec, cut: int) -> list[State]:
        found: list[State] = []
        for d in range(codec.longest):
            at = cut - d
            if is_cut(self.text, at):
                return [*found, (d, "")]
            if at <= 0:
                break
            found += [(d, p) for p in codec.to(self.text, at)]
        return found

    def _spread(self, codec: Codec, starts: dict[State, np.ndarray], stop: int, back: dict | None = None) -> dict[int, dict[str, np.ndarray]]:
        """Best weights of the nodes reached from states at the left cut, up to `stop`."""
        nodes: dict[int, dict[str, np.ndarray]] = {}
        for (d, p), w in starts.items():
            nodes.setdefault(self.lo - d, {})[p] = w
        for at in range(min(nodes, default=stop), stop):
            if at not in nodes:
                continue
            if is_cut(self.text, at):  # from here on it does not matter how the word before ended
                best = max(nodes[at], key=lambda p: nodes[at][p].max())
                if back is not None:
                    back[at, ""] = back.get((at, best))
                nodes[at] = {"": np.maximum.reduce(list(nodes[at].values()))}
            for p in codec.from_(self.text, at):
                end = at + len(p)
                if end > stop or (at <= self.lo and end <= self.lo and not self.first):
                    continue  # a state is the last node before the cut
                for before, w in nodes[at].items():
                    if before == "" or codec.compatible(before, p):
                        into = nodes.setdefault(end, {})
                        if p not in into:
                            into[p] = w
                            if back is not None:
                                back[end, p] = (at, before)
                        else:
                            into[p] = np.maximum(into[p], w)
        return nodes

    def _cuts(self) -> tuple[int, int] | None:
        cuts = [m.start() for m in re.finditer(f"(?<=[^{SPACE}]){SPACE}", self.text[: self.hi + 1]) if self.lo <= m.start() <= self.hi]
        return (cuts[0], cuts[-1]) if cuts else None

    def matrix(self, codec: Codec) -> tuple[list[State], list[State], np.ndarray]:
        """Transfer from the states at the left cut to those at the right one."""
        entries, exits = self.entries(codec), self.exits(codec)
        one = {s: np.where(np.arange(len(entries)) == i, 0.0, NEVER) for i, s in enumerate(entries)}
        cuts = self._cuts()
        if cuts is None:
            nodes = self._spread(codec, one, self.hi)
            out = [self._at(nodes, s, len(entries)) for s in exits]
            return entries, exits, np.array(out).T.reshape(len(entries), len(exits))
        a, b = cuts
        into = [w for w in self._spread(codec, one, a).get(a, {}).values()]
        left = np.maximum.reduce(into) if into else np.full(len(entries), NEVER)
        nodes = Chunk(self.text, b, self.hi, True, self.last)._spread(codec, {(0, ""): np.zeros(1)}, self.hi)
        right = np.array([self._at(nodes, s, 1)[0] for s in exits])
        return entries, exits, left[:, None] + right[None, :]

    def _at(self, nodes, state: State, n: int) -> np.ndarray:
        d, p = state
        here = nodes.get(self.hi - d, {})
        found = list(here.values()) if p == "" else [here[p]] if p in here else []
        return np.maximum.reduce(found) if found else np.full(n, NEVER)

    def trace(self, codec: Codec, entry: State, leave: State) -> list[int]:
        """Ids of the pieces between the two states."""
        cuts = self._cuts()
        if cuts is None:
            return self._path(codec, entry, self.hi - leave[0], leave[1])
        a, b = cuts
        end = self.hi - leave[0]
        tail = Chunk(self.text, b, self.hi, True, self.last)._path(codec, (0, ""), end, leave[1]) if end > b else []
        return self._path(codec, entry, a, "") + (codec.units(self.text[a:b]) if b > a else []) + tail

    def _path(self, codec: Codec, entry: State, end: int, piece: str) -> list[int]:
        start = self.lo - entry[0]
        if start == end:
            return []
        back: dict = {}
        nodes = self._spread(codec, {entry: np.zeros(1)}, end, back)
        node, pieces = (end, piece or next(iter(nodes[end]))), []
        while node[0] > start:
            at, p = back[node]
            pieces.append(self.text[at: node[0]])
            node = (at, p)
        ids: list[int] = []
        for p in reversed(pieces):
            ids += [codec.ids[p]] if p in codec.ids else [codec.bytes[b] for b in p.encode()]
        return ids


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def join_states(left: list[State], right: list[State], matrix: np.ndarray) -> np.ndarray:
    """Columns of `matrix` (states `left`) put into the order of `right`; both describe one cut."""
    place = {s: i for i, s in enumerate(left)}
    return np.stack([matrix[:, place[s]] if s in place else np.full(len(matrix), NEVER) for s in right], axis=1)


def _pack(states: list[State]) -> tuple[list[int], list[str]]:
    return [d for d, _ in states], [p for _, p in states]


MATRIX = "doc string, idx long, din array<int>, pin array<string>, dout array<int>, pout array<string>, w array<double>"
ENDS = "doc string, idx long, d1 int, p1 string, d2 int, p2 string"


def _matrix_row(doc: str, idx: int, entries, exits, w) -> dict:
    (din, pin), (dout, pout) = _pack(entries), _pack(exits)
    return {"doc": doc, "idx": idx, "din": din, "pin": pin, "dout": dout, "pout": pout, "w": w.ravel().tolist()}


def _matrix_of(r) -> tuple[list[State], list[State], np.ndarray]:
    entries, exits = list(zip(map(int, r.din), r.pin)), list(zip(map(int, r.dout), r.pout))
    return entries, exits, np.asarray(r.w, dtype=float).reshape(len(entries), len(exits))


def _combine(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(group.sort_values("idx").itertuples())
    entries, exits, w = _matrix_of(rows[0])
    for r in rows[1:]:
        more_in, more_out, m = _matrix_of(r)
        w, exits = max_plus(join_states(exits, more_in, w), m), more_out
    return pd.DataFrame([_matrix_row(rows[0].doc, rows[0].idx // FAN, entries, exits, w)])


def _thread(group: pd.DataFrame) -> pd.DataFrame:
    """States at the cuts inside a group of which the outer two are known."""
    rows = list(group.sort_values("idx").itertuples())
    mats = [_matrix_of(r) for r in rows]
    first, last = (int(rows[0].d1), rows[0].p1), (int(rows[0].d2), rows[0].p2)
    # the best way from each state to the end, from the right
    rest = [np.array([0.0 if s == last else NEVER for s in mats[-1][1]])]
    for k in range(len(mats) - 1, -1, -1):
        entries, exits, m = mats[k]
        before = np.max(m + rest[0][None, :], axis=1)
        rest.insert(0, before if k == 0 else join_states(entries, mats[k - 1][1], before[None, :])[0])
    out, state = [], first
    for k, (entries, exits, m) in enumerate(mats):
        row = m[entries.index(state)] + rest[k + 1]
        leave = exits[int(np.argmax(row))]
        out.append({"doc": rows[k].doc, "idx": rows[k].idx, "d1": state[0], "p1": state[1], "d2": leave[0], "p2": leave[1]})
        state = leave
    return pd.DataFrame(out)


def _chunk(r) -> Chunk:
    return Chunk(r.chunk, int(r.lo), int(r.hi), bool(r.first_one), bool(r.last_one))


def _chunks(giants: DataFrame, size: int, pad: int) -> DataFrame:
    """Rows of (doc, text) cut into chunks, each with `pad` characters of context."""
    text = giants.select("doc", F.concat(F.lit(SPACE), F.translate("text", " ", SPACE)).alias("t"))
    n = F.char_length("t")
    cut = text.select("doc", "t", n.alias("n"), F.explode(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).alias("idx"))
    start, stop = F.col("idx") * size, F.least((F.col("idx") + 1) * size, F.col("n"))
    left = F.least(start, F.lit(pad))
    return cut.select(
        "doc", F.col("idx").cast("long").alias("idx"), F.col("t").substr(start - left + 1, stop - start + left + pad).alias("chunk"),
        left.alias("lo"), (left + stop - start).alias("hi"), (F.col("idx") == 0).alias("first_one"), (stop == F.col("n")).alias("last_one"))


def encode_giants(giants: DataFrame, model: bytes, size: int = CHUNK) -> DataFrame:
    """(doc, ids) of rows (doc, text), doc being unique."""
    scratch = Scratch(giants.sparkSession, "pieces")
    pad = 3 * Codec(model).longest
    # one task per few chunks, however few files the documents came from
    chunks = _chunks(giants, size, pad).repartition("doc", "idx")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model)
        for b in batches:
            yield pd.DataFrame([_matrix_row(r.doc, r.idx, *_chunk(r).matrix(codec)) for r in b.itertuples()])

    def traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model)
        for b in batches:
            yield pd.DataFrame([{"doc": r.doc, "idx": r.idx, "ids": _chunk(r).trace(codec, (int(r.d1), r.p1), (int(r.d2), r.p2))}
                                for r in b.itertuples()])

    levels = [scratch.store(chunks.mapInPandas(matrices, MATRIX))]
    group = F.floor(F.col("idx") / FAN)
    while True:
        up = scratch.store(levels[-1].groupBy("doc", group).applyInPandas(_combine, MATRIX))
        levels.append(up)
        if up.where("idx > 0").isEmpty():
            break
    ends = levels[-1].select("doc", "idx", F.lit(0).alias("d1"), F.lit("").alias("p1"), F.lit(0).alias("d2"), F.lit("").alias("p2"))
    for level in reversed(levels[:-1]):
        known = ends.select(F.col("doc").alias("of"), F.col("idx").alias("g"), "d1", "p1", "d2", "p2")
        ends = scratch.store(level.join(known, (F.col("doc") == F.col("of")) & (group == F.col("g"))).drop("of", "g")
                             .groupBy("doc", group).applyInPandas(_thread, ENDS))
    ends = ends.withColumnsRenamed({"doc": "of", "idx": "at"})
    traced = chunks.join(ends, (F.col("doc") == F.col("of")) & (F.col("idx") == F.col("at"))).drop("of", "at").mapInPandas(
        traces, "doc string, idx long, ids array<int>")
    # a document's ids are one value of one row, as its text is
    return traced.groupBy("doc").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", "ids"))), lambda x: x["ids"])).alias("ids"))


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, ids."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for b in batches:
            found = [np.array(codec.encode(t), dtype=np.int32) for t in b.column("text").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            flat = np.concatenate(found) if found else np.array([], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc_id", "ids"])

    giant = F.char_length("text") >= chunk
    small = rows.where(~giant).mapInArrow(run, schema)
    keyed = rows.where(giant).select("doc_id", F.sha2("text", 256).alias("doc"), "text")
    giants = encode_giants(keyed.groupBy("doc").agg(F.first("text").alias("text")), model, chunk)
    return small.unionByName(keyed.select("doc_id", F.col("doc").alias("of")).join(giants, F.col("of") == F.col("doc")).select("doc_id", "ids"))


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """`encoded` with the text of its ids; NULL ids give an empty text."""
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(model)
        for b in batches:
            yield pd.Series([codec.decode(i if i is not None else ()) for i in b], dtype=object)

    return small_batches(encoded).withColumn(text_col, texts(F.col(f"`{ids_col}`")))
