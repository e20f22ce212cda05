"""The trie of all conversation beginnings, from sorted conversations and their common prefixes.

Turns are (role, text); a node is a different sequence of first turns, its members are the conversations that start so.

1. **Places.** Turns are range-sorted by conversation, so that a turn's place is its number in the partition plus what earlier
   partitions hold of the conversation. No conversation is gathered; a turn goes on as two 64-bit hashes of its place, role and text.
2. **Chunks.** `WIDTH` turns in a row of one conversation are a row. A chunk's header is the running hash of all turns
   before it, so chunks of equal headers continue equal beginnings, and a conversation of any length is rows of bounded size.
3. **Intervals.** Rows are range-sorted by header and turns, and cut into blocks of `BLOCK`. In a block, the common prefix
   of each row with the one before it goes into a sparse table of range minima. Each candidate prefix (one that the row
   before does not have) searches its left and right extent there by halving steps, independently of all others: while the
   least common prefix on the way is no shorter, the extent grows. The smallest member comes from a sparse table of ids.
4. **Across blocks.** Only prefixes whose interval touches an end of its block can go on in the next one: at most one path on
   either side. They are merged by their hash; counts add up, ends are digested in order as a stream.
5. **Subtrees.** What a node saves is charged to its smallest member. A subtree's sum is then what is charged to its members (a
   difference of running totals over the interval) less what its top's ancestors charged to the top's smallest member.

Every table of nodes is grouped with a partial aggregate first; a beginning that a third of all conversations share is an interval
over many blocks. Only its digest must read the ends of one node in one order; that is a stream of joined pieces.

Defined results: a NULL role or text counts as empty. Rows without conversation id belong to no conversation and are left out.
Turns are ordered by turn, NULL first; turns that tie by the MD5 of role and text. Repeated rows are turns like others. A
conversation that is left without turns is a member of the root only. An empty table has no root and gives an empty table.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch, arrow_rows

WIDTH = 32       # turns of a chunk
BLOCK = 8192     # chunks
BLOCKS = 4       # of which Python gets at a time
EMPTY = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "k1", "k2"]


# -- turns and chunks -------------------------------------------------------------------------------------------------


def ordered_turns(turns: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, pid, at, d, chars) of every turn in order, and (conv, pid, first, n, before) of each partition's share.

    A turn's place in its conversation is at - first + before.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        digest.alias("d"), F.char_length(text).cast("long").alias("chars")).where("conv IS NOT NULL")
    by = ["conv", "turn", "d"]
    at = F.monotonically_increasing_id()
    placed = scratch.store(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("conv", "d", "chars", at.alias("at")))
    placed = placed.withColumn("pid", F.shiftright("at", 33))
    shares = placed.groupBy("conv", "pid").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return placed, scratch.store(shares.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def whole_conversations(placed: DataFrame, shares: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, p, d, chars) of every turn and (conv, total), conversations as they are."""
    turns = placed.join(shares, ["conv", "pid"]).select("conv", (F.col("at") - F.col("first") + F.col("before")).alias("p"), "d", "chars")
    return turns, shares.groupBy("conv").agg(F.sum("n").alias("total"))


def shared_heads(placed: DataFrame, shares: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The same for rebuilt conversations: the first h turns come from the group's first conversation.

    h is crc32(decimal id) % `most`; a conversation's own first h turns are left out.
    """
    sizes = shares.groupBy("conv").agg(F.sum("n").alias("n"))
    base = F.col("conv") - F.col("conv") % group
    of_base = sizes.where(F.col("conv") % group == 0).select(F.col("conv").alias("b"), F.col("n").alias("nb"))
    sizes = sizes.select("conv", "n", base.alias("base"), (F.crc32(F.col("conv").cast("string")) % most).alias("h")).join(
        of_base, F.col("base") == F.col("b"), "left").select(
        "conv", "n", "base", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("m"))
    known = shares.join(sizes.select("conv", "h", "m"), "conv").select("conv", "pid", "first", "before", "h", "m")
    turns = placed.join(known, ["conv", "pid"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
    own = turns.where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("p"), "d", "chars")
    # a head turn goes to the conversations of its group only
    heads = turns.where((F.col("conv") % group == 0) & (F.col("pos") < most - 1)).select(
        F.col("conv").alias("hb"), F.col("pos").alias("hp"), "d", "chars")
    wanted = sizes.where("m > 0").select("conv", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("p"))
    given = wanted.join(heads, (F.col("base") == F.col("hb")) & (F.col("p") == F.col("hp"))).select("conv", "p", "d", "chars")
    totals = sizes.select("conv", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    return own.unionByName(given), totals


def _chunks(turns: DataFrame, totals: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, c, h1, h2, t1, t2, chars, last): the chunks of all conversations; an empty one for those without turns."""
    hashed = turns.select("conv", F.floor(F.col("p") / WIDTH).alias("c"), F.struct(
        "p", F.xxhash64("p", "d").alias("x"), F.xxhash64(F.lit("second"), "d", "p").alias("y"), "chars").alias("t"))
    rows = hashed.groupBy("conv", "c").agg(F.array_sort(F.collect_list("t")).alias("t"), F.bit_xor("t.x").alias("x"), F.bit_xor("t.y").alias("y"))
    none = totals.where("total = 0").select("conv", F.lit(0).cast("long").alias("c"), F.from_json(F.lit("[]"), rows.schema["t"].dataType).alias("t"),
                                            F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    rows = scratch.store(rows.unionByName(none))
    # only conversations that fill a chunk have a second one
    narrow = rows.where((F.size("t") == WIDTH) | (F.col("c") > 0)).select(F.col("conv").alias("nc"), F.col("c").alias("cc"), "x", "y")
    in_order = Window.partitionBy("nc").orderBy("cc")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = narrow.select("nc", "cc", F.bit_xor("x").over(earlier).alias("h1"), F.bit_xor("y").over(earlier).alias("h2"),
                           F.lead("cc").over(in_order).isNull().alias("final"))
    zero = F.lit(0).cast("long")
    return rows.join(narrow, (F.col("conv") == F.col("nc")) & (F.col("c") == F.col("cc")), "left").select(
        "conv", "c", F.coalesce("h1", zero).alias("h1"), F.coalesce("h2", zero).alias("h2"),
        F.col("t.x").alias("t1"), F.col("t.y").alias("t2"), F.col("t.chars").alias("chars"), F.coalesce("final", F.lit(True)).alias("last"))


# -- intervals of a block ---------------------------------------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """table[j][i]: the least of the 2**j values from i on."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half, last = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    return table


def least(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least value of each range lo to hi, both included."""
    j = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), dtype=table[0].dtype)
    for level in np.unique(j):
        at = j == level
        out[at] = np.minimum(table[level][lo[at]], table[level][hi[at] - (1 << level) + 1])
    return out


def extents(table: list[np.ndarray], rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share `lengths` with `rows`, for all candidates at once and each for itself.

    table[0][i] is what rows i - 1 and i share.
    """
    n = len(table[0])
    lo, hi = rows.copy(), rows.copy()
    for j in range(len(table) - 1, -1, -1):
        step, level = 1 << j, table[j]
        at = np.flatnonzero(hi + step < n)
        grows = at[level[hi[at] + 1] >= lengths[at]]
        hi[grows] += step
        at = np.flatnonzero(lo - step >= 0)
        grows = at[level[lo[at] - step + 1] >= lengths[at]]
        lo[grows] -= step
    return lo, hi


def shared_lengths(headers: np.ndarray, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What each row shares with the one before it: 0 for another header, else 1 and the number of equal first tokens."""
    n = len(sizes)
    shared = np.zeros(n, dtype=np.int64)
    alive = np.flatnonzero((headers[1:] == headers[:-1]).all(axis=1)) + 1
    shared[alive] = 1
    u = 0
    while len(alive):
        alive = alive[(sizes[alive] > u) & (sizes[alive - 1] > u)]
        alive = alive[(tokens[starts[alive] + u] == tokens[starts[alive - 1] + u]).all(axis=1)]
        shared[alive] += 1
        u += 1
    return shared


def block_nodes(conv, c, headers, tokens, sizes, chars, last) -> dict[str, object]:
    """Nodes of one block of sorted chunks: key, parent's key, extent, members, characters, ends."""
    n = len(conv)
    starts = np.cumsum(sizes) - sizes
    shared = shared_lengths(np.column_stack((c, headers)), tokens, starts, sizes)
    # the header alone is the root, or the end of the chunk before
    new = np.maximum(shared, (c > 0).astype(np.int64))
    counts = np.maximum(sizes + 1 - new, 0)
    rows = np.repeat(np.arange(n), counts)
    length = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + new[rows] + 1
    running = np.vstack((np.zeros((1, 2), np.int64), np.bitwise_xor.accumulate(tokens, axis=0) if len(tokens) else tokens))
    base = running[starts] ^ headers

    def key(of: np.ndarray, tokens_read: np.ndarray) -> np.ndarray:
        return running[starts[of] + tokens_read] ^ base[of]

    keys = key(rows, length - 1)
    parents = key(rows, np.maximum(length - 2, 0))
    lo, hi = extents(sparse_table(shared), rows, length)
    first_conv = least(sparse_table(conv), lo, hi)
    texts = np.append(chars, 0)
    own = np.where(length > 1, texts[np.minimum(starts[rows] + length - 2, len(texts) - 1)], 0)
    # rows equal to the one before: a prefix's own rows come first in its interval, by id
    equal = np.append((shared == sizes + 1) & (np.append(-1, sizes[:-1]) == sizes), False)
    stops = np.flatnonzero(~equal)
    ends_here = np.flatnonzero(length == sizes[rows] + 1)
    edge = (lo == 0) | (hi == n - 1)
    digests, pieces = [EMPTY] * len(rows), [""] * len(rows)
    until = stops[np.searchsorted(stops, rows[ends_here], side="right")]
    for k, a, b in zip(ends_here.tolist(), rows[ends_here].tolist(), until.tolist()):
        text = ",".join(map(str, conv[a:b][last[a:b]].tolist()))
        if edge[k]:
            pieces[k] = text
        elif text:
            digests[k] = hashlib.sha256(text.encode()).hexdigest()
    return {"depth": c[rows] * WIDTH + length - 1, "k1": keys[:, 0], "k2": keys[:, 1], "p1": parents[:, 0], "p2": parents[:, 1],
            "conv": first_conv, "n": hi - lo + 1, "chars": own, "lo": lo, "hi": hi, "edge": edge, "digest": digests, "piece": pieces}


NODE = {"depth": "long", "k1": "long", "k2": "long", "p1": "long", "p2": "long", "conv": "long", "n": "long", "chars": "long",
        "lo": "int", "hi": "int", "edge": "boolean", "digest": "string", "piece": "string"}


def _blocks(chunks: DataFrame) -> DataFrame:
    """One row per block of sorted chunks: its number, the conversations in order, and its nodes."""
    def block(parts: list[pd.DataFrame], number: int) -> pd.DataFrame:
        b = pd.concat(parts)
        sizes = b["t1"].map(len).to_numpy(np.int64)
        flat = {k: np.concatenate([np.asarray(x, np.int64) for x in b[k]]) for k in ("t1", "t2", "chars")}
        conv = b["conv"].to_numpy(np.int64)
        nodes = block_nodes(conv, b["c"].to_numpy(np.int64), b[["h1", "h2"]].to_numpy(np.int64),
                            np.column_stack((flat["t1"], flat["t2"])), sizes, flat["chars"], b["last"].to_numpy(bool))
        return pd.DataFrame({"block": [number], "convs": [conv]} | {k: [v] for k, v in nodes.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        parts, held = [], 0
        for b in batches:
            while len(b):
                take = b.iloc[: BLOCK - held]
                b = b.iloc[BLOCK - held:]
                parts.append(take)
                held += len(take)
                if held == BLOCK:
                    yield block(parts, number)
                    number, parts, held = number + 1, [], 0
        if held:
            yield block(parts, number)

    by = ["c", "h1", "h2", "t1", "t2", "conv"]
    return chunks.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(
        run, "block long, convs array<long>, " + ", ".join(f"{k} array<{v}>" for k, v in NODE.items()))


# -- the trie ---------------------------------------------------------------------------------------------------------


def _same_key(right: str = "") -> Column:
    return (F.col("depth") == F.col(f"{right}depth")) & (F.col("k1") == F.col(f"{right}k1")) & (F.col("k2") == F.col(f"{right}k2"))


def _digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each node's pieces, joined by commas in the order of their blocks; a piece is read once and let go."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sha = None, None
        for b in batches:
            done = []
            for *now, piece in zip(b["depth"].tolist(), b["k1"].tolist(), b["k2"].tolist(), b["piece"]):
                if now != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = now, hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
            yield pd.DataFrame(done, columns=["depth", "k1", "k2", "found"])
        if key is not None:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=["depth", "k1", "k2", "found"])

    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "piece").mapInPandas(
        run, "depth long, k1 long, k2 long, found string")


def _nodes(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node once, those that reach over a block's end merged."""
    parts = blocks.select("block", F.explode(F.arrays_zip(*NODE)).alias("x")).select("block", "x.*")
    columns = [*KEY, "p1", "p2", "conv", "n", "chars", "digest"]
    border = scratch.store(parts.where("edge").drop("lo", "hi", "edge", "digest"))
    found = _digests(border.where("piece <> ''")).withColumnsRenamed({k: f"f_{k}" for k in KEY})
    merged = border.groupBy(*KEY).agg(*(F.min(k).alias(k) for k in ("p1", "p2", "conv", "chars")), F.sum("n").alias("n"))
    merged = merged.join(found, _same_key("f_"), "left").select(*columns[:-1], F.coalesce("found", F.lit(EMPTY)).alias("digest"))
    return scratch.store(parts.where("NOT edge").select(*columns).unionByName(merged))


def _sums_over_members(blocks: DataFrame, charged: DataFrame) -> DataFrame:
    """(key, charged, leaves): what is charged to each node's members, by differences of running totals."""
    places = blocks.select("block", F.posexplode("convs").alias("i", "conv"))
    zero = F.lit(0).cast("long")
    by_block = places.join(charged.withColumnRenamed("conv", "cc"), F.col("conv") == F.col("cc"), "left").groupBy(
        F.col("block").alias("of")).agg(F.array_sort(F.collect_list(F.struct(
            "i", F.coalesce("total", zero).alias("total"), F.coalesce("leaf", zero).alias("leaf")))).alias("s"))
    joined = blocks.select("block", *KEY, "lo", "hi").join(by_block, F.col("block") == F.col("of")).select(
        *KEY, "lo", "hi", F.col("s.total").alias("total"), F.col("s.leaf").alias("leaf"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                lo, hi = np.asarray(r.lo), np.asarray(r.hi)
                running = [np.concatenate(([0], np.cumsum(np.asarray(x, np.int64)))) for x in (r.total, r.leaf)]
                yield pd.DataFrame({"depth": r.depth, "k1": r.k1, "k2": r.k2} | {
                    k: x[hi + 1] - x[lo] for k, x in zip(("total", "leaves"), running)})

    return joined.mapInPandas(run, "depth long, k1 long, k2 long, total long, leaves long").groupBy(*KEY).agg(
        F.sum("total").alias("total"), F.sum("leaves").alias("leaves"))


def _charged_before(nodes: DataFrame) -> DataFrame:
    """`nodes` with `before`: what nodes above charge to the same conversation. Totals run over stretches of `WIDTH` first,
    so that a path of any length is not one sort."""
    nodes = nodes.withColumn("stretch", F.floor(F.col("depth") / WIDTH))
    sums = nodes.groupBy(F.col("conv").alias("sc"), F.col("stretch").alias("ss")).agg(F.sum("own").alias("s"))
    earlier = Window.partitionBy("sc").orderBy("ss").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sc", "ss", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("above"))
    inside = Window.partitionBy("conv", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return nodes.withColumn("inside", F.coalesce(F.sum("own").over(inside), F.lit(0))).join(
        sums, (F.col("conv") == F.col("sc")) & (F.col("stretch") == F.col("ss"))).withColumn("before", F.col("above") + F.col("inside"))


def trie(turns: DataFrame, totals: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    blocks = scratch.store(_blocks(_chunks(turns, totals, scratch)))
    nodes = _nodes(blocks, scratch)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("c_depth"), F.col("p1").alias("c_k1"), F.col("p2").alias("c_k2")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, _same_key("c_"), "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"), ((F.col("n") - 1) * F.col("chars")).alias("own"))
    nodes = scratch.store(_charged_before(nodes).drop("sc", "ss", "above", "inside", "stretch"))
    charged = nodes.groupBy("conv").agg(F.sum("own").alias("total"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    with arrow_rows(turns.sparkSession, BLOCKS):
        sums = scratch.store(_sums_over_members(blocks, charged))
    sums = sums.withColumnsRenamed({k: f"s_{k}" for k in KEY})
    # the root's children are looked up without a join: its smallest member is one number
    root = nodes.where("depth = 0").agg(F.min("conv")).first()[0]
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("q_depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv").alias("q"))
    summed = nodes.join(sums, _same_key("s_"))
    parent = F.when(F.col("depth") == 1, F.lit(root).cast("long")).otherwise(F.col("q"))
    deep = (F.col("depth") == F.col("q_depth")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2"))
    return summed.where("depth > 1").join(parents, deep).unionByName(
        summed.where("depth <= 1"), allowMissingColumns=True).select(
        F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), (F.col("total") - F.col("before")).alias("saved_tokens"), F.col("digest").alias("ends_sha256"))


def prefix_trie(turns: DataFrame, rebuild=shared_heads, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """The trie of a table of turns; `rebuild` says of which turns a conversation is made (`whole_conversations`: its own)."""
    scratch = Scratch(turns.sparkSession, "trie")
    placed, shares = ordered_turns(turns, scratch, conv_col, turn_col, role_col, text_col)
    return trie(*rebuild(placed, shares), scratch)
