"""Removal of repeated passages by suffix arrays.

A byte goes if it lies in a string of `LENGTH` bytes that also starts anywhere else. Strings that are equal
must meet in one shard without every shard meeting every other one, so texts are dealt out by content:

1. **Runs.** The smallest hash of the `GRAM`-byte grams inside a window of `LENGTH` bytes depends on its content alone.
   Consecutive windows with the same smallest hash are a *run*; equal windows lie in runs of equal hash. A run's
   bytes are described by hash, digest and place only.
2. **Equal runs** are counted by hash and digest. All windows of a run that occurs twice are repeated, and their
   text never moves. Of runs that share a hash with others and are not settled that way, one text per digest is fetched.
3. **Shards.** Those texts are dealt to shards of about `SHARD_BYTES`, a hash with more text than that to several. Each
   shard sorts its suffixes by Larsson-Sadakane refinement and finds common prefixes by Kasai's algorithm, both in numpy;
   neighbours that share `LENGTH` bytes are repeated windows.
4. **Merging.** Windows of a hash that went to several shards and are single there may have their like in another. Each shard hands on
   the fingerprints of these in order; they are cut into ranges, and the lists of a range are searched for each other's entries by binary search.

Everything that grows with the data is a Spark table; a task holds one batch of texts, one shard or one range.

Defined results: a NULL text counts as empty. A text shorter than `LENGTH` loses nothing. Copies and repeated rows are removed
everywhere, as each starts elsewhere too. NULL ids are kept. A very long text is cut into runs of at most `LONGEST_RUN` windows and
described block by block; only the text itself is held whole. Nothing depends on an order of rows, so there are no ties. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, small_batches

LENGTH = 400
GRAM = 64              # a power of two; shorter grams are shared by texts that have nothing else in common
SHARD_BYTES = 1 << 20
LONGEST_RUN = 1 << 16
BLOCK = 1 << 20        # windows described at a time
RANGE_ROWS = 1 << 16   # fingerprints merged at a time
LANES = 256
# fixed values: odd multipliers of a hash
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9], dtype=np.uint64)


def words_at(data: bytes, n: int) -> np.ndarray:
    """The eight bytes from each of `n` places, as one little-endian number; zeros follow the end."""
    padded = data + bytes(16)
    words = np.empty(n, dtype=np.uint64)
    for j in range(8):
        part = words[j::8]
        part[:] = np.frombuffer(padded, dtype="<u8", offset=j, count=len(part)) if len(part) else part
    return words


def runs(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, digest, start, number of windows, whether the hash occurs twice) of each run."""
    import xxhash
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - length + 1, BLOCK):
        part = data[at: at + BLOCK + length - 1]
        n, span = len(part), length - GRAM + 1
        grams, reach = words_at(part, n - 7), 8
        while reach < GRAM:  # two neighbouring hashes are one of twice the length
            grams = grams[:-reach] * MIX[0] ^ (grams[reach:] >> np.uint64(7)) * MIX[1]
            grams = (grams ^ (grams >> np.uint64(29))) * MIX[2]
            reach *= 2
        grams ^= grams >> np.uint64(32)
        # least of each span, from the least up to and from each place within blocks of a span
        tiles = np.full(-(-len(grams) // span) * span, np.iinfo(np.uint64).max)
        tiles[: len(grams)] = grams
        tiles = tiles.reshape(-1, span)
        upto = np.minimum.accumulate(tiles, axis=1).ravel()
        onward = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        n_windows = n - length + 1
        least = np.minimum(onward[:n_windows], upto[span - 1: span - 1 + n_windows])
        starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        counts = np.diff(np.append(starts, n_windows))
        if counts.max() > LONGEST_RUN:
            pieces = [np.arange(s, s + c, LONGEST_RUN) for s, c in zip(starts, counts)]
            starts = np.concatenate(pieces)
            counts = np.diff(np.append(starts, n_windows))
        digests = np.array([xxhash.xxh3_64_intdigest(part[s: s + c + length - 1]) for s, c in zip(starts.tolist(), counts.tolist())],
                           dtype=np.uint64).view(np.int64)
        keys = least[starts]
        twice = np.array([np.count_nonzero(grams[s: s + c + span - 1] == k) > 1
                          for s, c, k in zip(starts.tolist(), counts.tolist(), keys)])
        found.append((keys.view(np.int64), digests, (starts + at).astype(np.int32), counts.astype(np.int32), twice))
    return tuple(np.concatenate(c) for c in zip(*found))


def suffix_array(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): Larsson-Sadakane. Suffixes are sorted by eight bytes, then groups that are still
    equal are refined by the rank of what follows, over a distance that doubles."""
    n = len(data)
    key = words_at(data, n).byteswap()
    # zeros after the end must not equal zeros in the text: of equal keys the shorter suffix comes first
    left = np.minimum(n - np.arange(n), 8)
    order = n - 1 - np.argsort(key[::-1], kind="stable")
    changed = np.ones(n, dtype=bool)
    changed[1:] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] != left[order[:-1]])
    first = np.flatnonzero(changed)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    h, places = 8, np.arange(n)
    while True:
        # places in the order whose group has more than one member
        groups = rank[order[places]]
        same = np.zeros(len(places), dtype=bool)
        equal = groups[1:] == groups[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        places, groups = places[same], groups[same]
        if not len(places):
            return order, rank
        members = order[places]
        after = members + h
        behind = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        by = np.argsort(groups * (n + 1) + behind + 1)
        members, groups, behind = members[by], groups[by], behind[by]
        order[places] = members
        changed = np.ones(len(places), dtype=bool)
        changed[1:] = (groups[1:] != groups[:-1]) | (behind[1:] != behind[:-1])
        first = np.flatnonzero(changed)
        rank[members] = np.repeat(places[first], np.diff(np.append(first, len(places))))
        h *= 2


def common_prefixes(data: bytes, order: np.ndarray, rank: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Length, up to `most`, that each suffix shares with the one before it in the order.

    Kasai: the next suffix of the text shares at most one byte less. The text is walked in `LANES` steps
    by all of its stretches side by side.
    """
    n = len(data)
    words = words_at(data + bytes(most + 8), n + most)
    shared = np.zeros(n, dtype=np.int64)
    step = max(1, -(-n // LANES)) if n < LANES * LANES else LANES
    lanes = np.arange(0, n, step)
    known = np.zeros(len(lanes), dtype=np.int64)
    for r in range(step):
        i = lanes + r
        i = i[i < n]
        known = np.maximum(known[: len(i)] - 1, 0)
        j = order[rank[i] - 1]  # of the first suffix this is the last, set right below
        limit = np.minimum(most, n - np.maximum(i, j))
        known = np.where(rank[i] > 0, known, 0)
        active = np.flatnonzero((rank[i] > 0) & (known < limit))
        while len(active):
            at = known[active]
            x = words[i[active] + at] ^ words[j[active] + at]
            known[active] = at + np.where(x == 0, 8, np.bitwise_count((x & -x) - np.uint64(1)) // 8)
            active = active[(x == 0) & (known[active] < limit[active])]
        known = np.minimum(known, np.where(rank[i] > 0, limit, 0))
        shared[rank[i]] = known
    return shared


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its windows of `length` bytes start more than once among all of the texts'."""
    data = b"".join(texts)
    order, rank = suffix_array(data)
    shared = common_prefixes(data, order, rank, length)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    window = np.zeros(len(data), dtype=bool)
    for a, b in zip(bounds[:-1], bounds[1:]):
        window[a: max(a, b - length + 1)] = True
    # suffixes that begin a window, in order; what two neighbours share is the least on the way
    at = np.flatnonzero(window[order])
    again = np.zeros(len(data), dtype=bool)
    if len(at) > 1:
        equal = np.minimum.reduceat(shared[: at[-1] + 1], at[:-1] + 1) >= length
        again[order[at[1:]][equal]] = True
        again[order[at[:-1]][equal]] = True
    return [again[a: max(a, b - length + 1)] for a, b in zip(bounds[:-1], bounds[1:])]


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, count) of the stretches of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()))


def _described(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(id, h, m, d, at, n, twice): all runs of all texts; `h` tells texts of equal id apart."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [runs(t, length) for t in b["data"]]
            yield pd.DataFrame({"id": b["id"], "h": b["h"]} | {c: [f[i] for f in found] for i, c in enumerate(("m", "d", "at", "n", "twice"))})

    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(data).alias("h"), data.alias("data")).where(
        F.octet_length("data") >= length).mapInPandas(
        run, f"id {key}, h long, m array<long>, d array<long>, at array<int>, n array<int>, twice array<boolean>")


def _shard(length: int):
    """Repeated windows of one shard's texts; where a hash has several shards, also the fingerprints to merge."""
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        import xxhash
        settled: set[bytes] = set()
        out: dict[str, list] = {c: [] for c in ("id", "h", "m", "at", "spans", "places", "f1", "f2")}
        for r, again in zip(batch.itertuples(), repeated_windows(batch["data"].tolist(), length)):
            places, prints = [], []
            if r.parts > 1:
                for p, known in enumerate((again | (r.copies > 1)).tolist()):
                    f = xxhash.xxh3_128_digest(r.data[p: p + length])
                    if not known:
                        places.append(p)
                        prints.append(f)
                    elif f not in settled:  # what is repeated here only answers for other shards
                        settled.add(f)
                        places.append(-1)
                        prints.append(f)
            halves = np.frombuffer(b"".join(prints), dtype="<i8").reshape(-1, 2)
            for c, v in (("id", r.id), ("h", r.h), ("m", r.m), ("at", r.at), ("places", places), ("f1", halves[:, 0]), ("f2", halves[:, 1]),
                         ("spans", [{"a": a, "n": n} for a, n in _spans(again)] if r.copies == 1 else [])):
                out[c].append(v)
        return pd.DataFrame(out).astype({"id": batch["id"].dtype})
    return run


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """Windows of one range of fingerprints that stand in more than one place of the shards' lists."""
    group = group.sort_values(["f1", "f2", "m"])
    f1 = group["f1"].to_numpy()
    # binary search in the merged list for both ends of each entry
    met = np.searchsorted(f1, f1, side="right") - np.searchsorted(f1, f1, side="left") > 1
    rest = group[["f2", "m"]].to_numpy()
    same = (f1[1:] == f1[:-1]) & (rest[1:] == rest[:-1]).all(axis=1)
    equal = np.zeros(len(f1), dtype=bool)
    equal[1:] |= same
    equal[:-1] |= same
    return group[met & equal & (group["place"].to_numpy() >= 0)][["id", "h", "at", "place"]]


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, scratch: Scratch | None = None) -> DataFrame:
    """(id, h, at, n): stretches of starts of repeated windows; a stretch may be listed more than once."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "suffix")
    key = docs.schema[id_col].dataType.simpleString()
    described = scratch.store(_described(docs, id_col, text_col, length))
    found = described.select("id", "h", F.explode(F.arrays_zip("m", "d", "at", "n", "twice")).alias("r")).select("id", "h", "r.*")
    # a hash with one run is only of interest if that run may repeat itself
    shared = found.groupBy(F.col("m").alias("k")).agg(
        F.count("*").alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.bool_or("twice").alias("t")).where("c > 1 OR t").select(
        "k", ((F.col("lo") != F.col("hi")) | ((F.col("c") == 1) & F.col("t"))).alias("mixed"))
    candidates = scratch.store(found.join(shared, F.col("m") == F.col("k")).select("id", "h", "m", "d", "at", "n", "mixed"))
    mixed = candidates.where("mixed")
    classes = scratch.store(mixed.groupBy("m", "d").agg(F.count("*").alias("copies"), F.min(F.struct("id", "h", "at", "n")).alias("r")))
    copied = mixed.join(classes.where("copies > 1").select(F.col("m").alias("k"), F.col("d").alias("kd")),
                        (F.col("m") == F.col("k")) & (F.col("d") == F.col("kd")), "left_semi")
    # one text per digest, of the hashes for which something is open
    size = (F.col("r.n") + (length - 1)).cast("long")
    open_ = classes.groupBy(F.col("m").alias("k")).agg(F.min("copies").alias("least"), F.sum(size).alias("bytes")).where("least = 1").select(
        "k", F.ceil(F.col("bytes") / SHARD_BYTES).alias("parts"))
    wanted = scratch.store(classes.join(open_, F.col("m") == F.col("k")).select("m", "d", "copies", "parts", "r.*"))
    total, most = wanted.agg(F.sum(F.col("n") + length - 1), F.max("parts")).first()
    n_shards = max(1, -(-(total or 0) // SHARD_BYTES))
    asked = wanted.groupBy(F.col("id").alias("of"), F.col("h").alias("oh")).agg(
        F.collect_list(F.struct("m", "d", "copies", "parts", "at", "n")).alias("w"))
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(data).alias("h"), data.alias("data"))
    # rows that repeat id and text are one text here
    name = ["name", "h"]
    fetched = _named(texts, "id").join(_named(asked, "of").withColumnRenamed("oh", "h").drop("of"), name).dropDuplicates(name)
    parts = fetched.select("id", "h", "data", F.explode("w").alias("w")).select(
        "id", "h", "w.m", "w.copies", "w.parts", "w.at", F.substring("data", F.col("w.at") + 1, F.col("w.n") + (length - 1)).alias("data"),
        F.pmod(F.xxhash64("w.m", F.pmod("w.d", "w.parts")), F.lit(n_shards)).alias("shard"))
    sharded = scratch.store(parts.groupBy("shard").applyInPandas(
        _shard(length), f"id {key}, h long, m long, at int, spans array<struct<a:int,n:int>>, places array<int>, f1 array<long>, f2 array<long>"))
    marks = [candidates.where("NOT mixed").select("id", "h", "at", "n"), copied.select("id", "h", "at", "n"),
             sharded.select("id", "h", "at", F.explode("spans").alias("s")).select("id", "h", (F.col("at") + F.col("s.a")).alias("at"), F.col("s.n").alias("n"))]
    if (most or 1) > 1:
        prints = sharded.select("id", "h", "m", "at", F.explode(F.arrays_zip("places", "f1", "f2")).alias("f")).select(
            "id", "h", "m", "at", F.col("f.places").alias("place"), "f.f1", "f.f2")
        n_ranges = max(1, -(-prints.count() // RANGE_ROWS))
        prints = prints.withColumn("range", F.floor((F.col("f1") / float(1 << 64) + 0.5) * n_ranges))
        merged = prints.groupBy("range").applyInPandas(_merge, f"id {key}, h long, at int, place int")
        marks.append(merged.select("id", "h", (F.col("at") + F.col("place")).alias("at"), F.lit(1).alias("n")))
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def _named(df: DataFrame, id_col: str) -> DataFrame:
    """`df` with a name for each id that is never NULL, so that a join and a grouping share one exchange."""
    return df.withColumn("name", F.concat(F.col(id_col).isNull().cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _covered(n: int, spans, length: int) -> np.ndarray:
    """Which of `n` bytes lie in a repeated window."""
    edges = np.zeros(n + 1, dtype=np.int64)
    if spans is not None and len(spans):
        at = np.array([s["at"] for s in spans])
        count = np.array([s["n"] for s in spans])
        np.add.at(edges, at, 1)
        np.add.at(edges, at + count + length - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the bytes that are kept."""
    # rows that repeat id and text have the same stretches, which are listed once
    spans = repeated(docs, id_col, text_col, length).distinct().groupBy(F.col("id").alias("of"), F.col("h").alias("oh")).agg(
        F.collect_list(F.struct("at", "n")).alias("spans"))
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    texts = small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(data).alias("h"), data.alias("data"))
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, s in zip(b["id"], b["data"], b["spans"]):
                gone = _covered(len(t), s, length)
                kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes() if gone.any() else t
                rows.append((i, len(t), int(gone.sum()), len(_spans(gone)), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": b["id"].dtype})

    return texts.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("oh")), "left").select(
        "id", "data", "spans").mapInPandas(run, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept binary")
