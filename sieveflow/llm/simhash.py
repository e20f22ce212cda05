"""Near duplicates by SimHash, linked through an inverted index of byte positions.

Two 64-bit fingerprints that differ in at most `MAX_BITS` = 2 bits differ in at most two of their
eight bytes, so they share at least six (position, byte) postings: that is the guaranteed
minimum of the count filter. Lists of single postings hold 1/256 of all fingerprints each, and
tallying them pair by pair would grow with the square of the input. The tally is therefore
taken by key: a pair reaches six shared postings exactly when it agrees on one of the 28
choices of six positions, so each fingerprint is entered under these 28 keys (its postings at
six positions) and pairs below the minimum never meet.

Inside a list only two bytes vary, so it has at most 65,536 different fingerprints whatever the
input. There pairs are verified by their differing bits, and each group of a list comes out as links
to its smallest member instead of all its pairs. Distinct fingerprints stand for all their
documents, so copies are never expanded into pairs.

Defined results: a NULL or empty text has no shingle and fingerprint 0, which links like any
other. A text of fewer words than a shingle is one shingle. A NULL id takes part, but is never
the name of a group unless all its ids are NULL. Repeated rows give repeated rows; where one of them is kept, it is the one whose
whole row has the least hash. Very long texts are hashed `BLOCK` shingles at a time. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, row_hash, small_batches

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BLOCK = 1 << 16  # shingles whose bits are counted at a time


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# masks of six of the eight byte positions
SIX_BYTES = [_signed(0xFFFFFFFFFFFFFFFF ^ (0xFF << 8 * i) ^ (0xFF << 8 * j)) for i, j in combinations(range(8), 2)]


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of UTF-8 bytes: a bit is set if it is set in over half of the shingle hashes."""
    import xxhash
    words = text.lower().split()  # for bytes: A-Z only, and exactly the white space of WORD
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1:].tolist()) if len(words) >= size else [(0, len(joined))]
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at: at + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": np.array(
                [_signed(fingerprint(t or b"", size)) for t in b["text"]], dtype=np.int64)})

    return small_batches(docs).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    ).mapInPandas(run, f"doc_id {id_type}, fp long")


def _groups_of_list(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) of the groups among the fingerprints of one list."""
    values = np.unique(values)
    low = np.arange(len(values))  # the smallest member known to be reachable
    pairs = []
    rows = max(1, (1 << 22) // len(values))
    for at in range(0, len(values), rows):
        # unsigned: of a signed number the bits of its absolute value would be counted
        bits = values.view(np.uint64)
        differing = np.bitwise_count(bits[at: at + rows, None] ^ bits[None, :])
        i, j = np.nonzero(differing <= max_bits)
        pairs.append(np.stack((i + at, j))[:, i + at > j])
    a, b = np.concatenate(pairs, axis=1)
    while len(a):
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if np.array_equal(before, low):
            break
    member = low != np.arange(len(values))
    return values[member], values[low[member]]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): enough verified links between different fingerprints to connect all that link."""
    if max_bits > 2:
        raise ValueError("six shared bytes are only guaranteed for at most two differing bits")
    # dealt out again: a few MB of fingerprints become 28 times as many rows
    n_tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = prints.select("fp").distinct().repartition(n_tasks).select("fp", F.posexplode(F.array(
        *(F.col("fp").bitwiseAND(F.lit(m)) for m in SIX_BYTES))).alias("choice", "postings"))
    lists = index.groupBy("choice", "postings").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_groups_of_list(np.asarray(v, dtype=np.int64), max_bits) for v in batch["fps"]]
            if found:
                yield pd.DataFrame({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    return lists.select("fps").mapInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(node, root) for every node of an edge (a, b), the root being one node per component.

    Each round joins every node to its smallest neighbour, follows that one step further, and
    carries the edges over to the joined nodes, until none is left between different ones.
    """
    edges, roots = scratch.store(edges), None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p")).select(
            "node", F.least("node", "p").alias("parent"))
        parent = scratch.store(parent)
        further = parent.select(F.col("node").alias("n2"), F.col("parent").alias("p2"))
        parent = scratch.store(parent.join(further, F.col("parent") == F.col("n2")).select("node", F.col("p2").alias("parent")))
        pa, pb = (parent.select(F.col("node").alias(f"n{s}"), F.col("parent").alias(f"p{s}")) for s in "ab")
        edges = scratch.store(
            edges.join(pa, F.col("a") == F.col("na")).join(pb, F.col("b") == F.col("nb")).where("pa <> pb")
            .select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct())
        if roots is None:
            roots = parent.withColumnRenamed("parent", "root")
        else:
            roots = scratch.store(roots.join(parent.withColumnRenamed("node", "n"), F.col("root") == F.col("n"), "left").select(
                "node", F.coalesce("parent", "root").alias("root")))
    return roots


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id
    reachable over links of at most `max_bits` differing bits)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.store(fingerprints(docs, id_col, text_col, size))
    roots = components(links(prints, max_bits), scratch)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    if roots is None:
        named = first.withColumn("component_id", F.col("first_id"))
    else:
        first = first.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root"))
        names = first.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
        named = first.join(names, F.col("root") == F.col("r"))
    named = named.select(F.col("fp").alias("f"), "component_id")
    return prints.join(named, F.col("fp") == F.col("f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def text_digest(text_col: str) -> Column:
    """16 bytes that stand for a text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))


def one_per_root(docs: DataFrame, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` with one row of each group: that of the smallest id, of a NULL id if it has no other.

    `roots` has (digest, root) for each different text, so a row is judged by its own text whatever its id.
    """
    rows = docs.select(F.struct("*").alias("__row"), F.col(f"`{id_col}`").alias("__doc"), text_digest(text_col).alias("__digest"))
    counts = rows.groupBy("__digest", "__doc").agg(F.count("*").alias("n"))
    first = counts.join(roots, F.col("__digest") == F.col("digest")).groupBy("root").agg(F.min(F.struct(
        F.col("__doc").isNull().alias("unnamed"), F.col("__doc").alias("id"), "digest", "n")).alias("k"))
    kept = first.select(F.col("k.id").alias("__id"), F.col("k.digest").alias("__of"), F.col("k.n").alias("__n"))
    rows = rows.join(kept, (F.col("__digest") == F.col("__of")) & F.col("__doc").eqNullSafe(F.col("__id")))
    single = rows.where("__n = 1").select("__row.*")
    repeated = rows.where("__n > 1").groupBy("__digest", "__doc").agg(F.min_by("__row", row_hash(docs, "__row")).alias("__row")).select("__row.*")
    return reduce(DataFrame.unionByName, [single, repeated])


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` with one row of each group: that of the smallest id, of a NULL id if it has no other."""
    scratch = Scratch(docs.sparkSession, "simhash")
    texts = docs.select(text_digest(text_col).alias("digest"), F.col(f"`{text_col}`").alias("text"))
    prints = scratch.store(fingerprints(texts, "digest", "text", size).distinct())
    roots = components(links(prints, max_bits), scratch)
    named = prints.select(F.col("doc_id").alias("digest"), "fp")
    if roots is None:
        named = named.withColumnRenamed("fp", "root")
    else:
        named = named.join(roots, F.col("fp") == F.col("node"), "left").select("digest", F.coalesce("root", "fp").alias("root"))
    return one_per_root(docs, scratch.store(named), id_col, text_col)
