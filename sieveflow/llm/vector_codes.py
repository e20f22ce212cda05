"""Product quantization with metric trees: vectors as four-part codes, by exact integer Lloyd rounds.

Components become integers, vectors are cut into `PARTS` equal parts, and each part position has a codebook of
`ENTRIES` entries that `ROUNDS` rounds move to the floor of the mean of what is nearest to them.

1. **Trees.** Vectors are read in blocks of at most `BLOCK` rows. For each block and part, the different parts are
   organised middle-out: about the square root of their number of anchors, each taking what is nearer to it than to
   older ones (points too near to their anchor to be stolen are not looked at); anchors are then merged upwards into the
   most compact balls, and divided downwards in the same way. A ball caches centre, radius, count and sum. Trees are
   written once, as bounded arrays, and read in every round.
2. **A round** walks all balls of a depth together. The root starts with every entry; a ball inherits the entries that its
   parent could not rule out and drops each one that is farther than the nearest entry for all of the ball. A ball
   with one entry left hands over its cached count and sum. Only in leaves are points compared, with the entries left.
   Ruling out is by floating point with a margin on the side of keeping, deciding is by integers, ties to the lower index.
3. **Spark** adds up counts and sums by part and entry. What reaches the driver is the codebooks' size at every input size,
   and codebooks travel to the tasks with the function.

Trees are built where the rows are read, so vectors are never shuffled; copies of a part weigh more in one point, so a vector
that makes up a third of the rows costs one point a block. Errors are summed by label with a partial sum before the
shuffle, and joined back without a hint (Spark broadcasts by measured size, or splits a skewed join).

Defined results: rows whose vector is NULL or holds a NULL, NaN or infinite component are left out. Vectors shorter than
the longest, rounded up to a multiple of `PARTS`, count as filled up with zeros. Components are bounded by `LIMIT`, so that all
distances are exact in 64 bits. Repeated vec_ids are rows like others: the first entries are the first rows by (vec_id, vector), NULL
ids last. With fewer than `ENTRIES` rows there are as many entries as rows. An empty table gives an empty table. Other
columns are ignored; a missing label column counts as NULL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, arrow_rows

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 1 << 27    # of a component after scaling: squares of differences then add up within 64 bits
BLOCK = 4096       # vectors a tree is made of
BLOCKS = 4         # of which Python gets at a time
LEAF = 24          # points
CHUNK = 1 << 20    # numbers compared at a time


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(
        x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) < float("inf")))


# -- trees ------------------------------------------------------------------------------------------------------------


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = points - centre
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def anchors(points: np.ndarray, k: int) -> np.ndarray:
    """Owner (0 to k - 1) of each point among at most `k` anchors.

    Each new anchor is the point farthest from its own; it takes from an older one what is nearer to it, which can only be
    points farther from their anchor than half the distance between the two.
    """
    owner = np.zeros(len(points), dtype=np.int64)
    pivots = [points[0]]
    far = _distances(points, points[0])
    for new in range(1, k):
        at = int(np.argmax(far))
        if far[at] == 0:
            break
        between = _distances(np.array(pivots), points[at])
        asked = np.flatnonzero(far > between[owner] / 2)
        d = _distances(points[asked], points[at])
        won = d < far[asked]
        owner[asked[won]], far[asked[won]] = new, d[won]
        pivots.append(points[at])
    return owner


def _merged(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Which two balls to merge, again and again, so that each new ball is as small as can be.

    Balls are numbered on: the first merger is number len(centres), and so on.
    """
    n = len(centres)
    centres, radii, counts = list(centres), list(radii), list(counts)
    size = np.full((2 * n - 1, 2 * n - 1), np.inf)
    live = list(range(n))

    def enter(i: int, others: list[int]) -> None:
        if others:
            d = _distances(np.array([centres[j] for j in others]), centres[i])
            size[i, others] = (d + radii[i] + np.array([radii[j] for j in others])) / 2

    for i in range(n):
        enter(i, live[:i])
    pairs = []
    for new in range(n, 2 * n - 1):
        a, b = np.unravel_index(np.argmin(size[:new, :new]), (new, new))
        pairs.append((int(a), int(b)))
        counts.append(counts[a] + counts[b])
        centres.append((centres[a] * counts[a] + centres[b] * counts[b]) / counts[new])
        radii.append(size[a, b])
        size[[a, b], :] = np.inf
        size[:, [a, b]] = np.inf
        live = [i for i in live if i not in (a, b)]
        enter(new, live)
        live.append(new)
    return pairs


def ball_tree(points: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Order of the points, and per ball: first and last point in that order, depth, parent, count and sum.

    Balls are listed by depth, so a parent comes before its children. A leaf is a ball that is no ball's parent.
    """
    real = points.astype(np.float64)
    order: list[np.ndarray] = []
    balls: list[tuple[int, int, int, int]] = []  # lo, hi, depth, parent
    placed = 0
    # (indices, depth, parent) of balls to divide, or a tree of mergers over groups already divided
    stack: list[tuple[object, int, int]] = [(np.arange(len(points)), 0, -1)]
    spans: list[list] = []
    while stack:
        what, depth, parent = stack.pop()
        me = len(spans)
        members = what if isinstance(what, np.ndarray) else what[1]
        spans.append([placed, placed + len(members), depth, parent])
        if not isinstance(what, np.ndarray):
            # children are pushed in reverse, so that the left one comes first
            stack.extend((child, depth + 1, me) for child in reversed(what[0]))
            continue
        if len(members) <= LEAF:
            order.append(members)
            placed += len(members)
            continue
        owner = anchors(real[members], max(2, int(len(members) ** 0.5)))
        groups = [members[owner == g] for g in range(owner.max() + 1)]
        if len(groups) == 1:  # equal points cannot occur; numerically equal ones stay a leaf
            order.append(members)
            placed += len(members)
            continue
        centres = np.array([real[g].mean(axis=0) for g in groups])
        radii = np.array([_distances(real[g], c).max() for g, c in zip(groups, centres)])
        nodes: list[object] = list(groups)
        held: list[np.ndarray] = list(groups)
        for a, b in _merged(centres, radii, np.array([len(g) for g in groups])):
            held.append(np.concatenate((held[a], held[b])))
            nodes.append(([nodes[a], nodes[b]], held[-1]))
        # the last merger is this ball itself: its two halves are the children
        stack.extend((child, depth + 1, me) for child in reversed(nodes[-1][0]))
    balls = np.array(spans, dtype=np.int64)
    order = np.concatenate(order)
    rank = np.argsort(balls[:, 2], kind="stable")
    number = np.empty(len(rank), dtype=np.int64)
    number[rank] = np.arange(len(rank))
    balls = balls[rank]
    balls[1:, 3] = number[balls[1:, 3]]
    weight = weights[order]
    total = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order] * weight[:, None], axis=0)))
    count = np.concatenate(([0], np.cumsum(weight)))
    lo, hi = balls[:, 0], balls[:, 1]
    return {"order": order, "lo": lo, "hi": hi, "depth": balls[:, 2], "parent": balls[:, 3],
            "count": count[hi] - count[lo], "sums": total[hi] - total[lo]}


def centres_and_radii(points: np.ndarray, tree: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each ball's different points and the distance of the farthest (`points` in the tree's order)."""
    real = points.astype(np.float64)
    total = np.concatenate((np.zeros((1, real.shape[1])), np.cumsum(real, axis=0)))
    lo, hi = tree["lo"], tree["hi"]
    centres = (total[hi] - total[lo]) / (hi - lo)[:, None]
    radii = np.empty(len(lo))
    for d in range(int(tree["depth"].max()) + 1):
        at = np.flatnonzero(tree["depth"] == d)
        n = hi[at] - lo[at]
        starts = np.cumsum(n) - n
        of = np.repeat(np.arange(len(at)), n)
        places = np.arange(n.sum()) - starts[of] + lo[at][of]
        radii[at] = np.maximum.reduceat(_distances(real[places], centres[at][of]), starts)
    return centres, radii


# -- a round ----------------------------------------------------------------------------------------------------------


def nearest(points: np.ndarray, lists: list[np.ndarray], codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest of each point's listed entries (ascending), ties to the lower one."""
    n = np.array([len(x) for x in lists])
    entry, least = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    step = max(1, CHUNK // (points.shape[1] * max(1, int(n.max(initial=1)))))
    for a in range(0, len(points), step):
        part = n[a: a + step]
        starts = np.cumsum(part) - part
        of = np.repeat(np.arange(len(part)), part)
        listed = np.concatenate(lists[a: a + step])
        d = points[a: a + step][of] - codebook[listed]
        d = np.einsum("ij,ij->i", d, d)
        low = np.minimum.reduceat(d, starts)
        hit = np.flatnonzero(d == low[of])
        first = hit[np.concatenate(([True], of[hit][1:] != of[hit][:-1]))]
        entry[a: a + step], least[a: a + step] = listed[first], low
    return entry, least


def owned(points: np.ndarray, tree: dict[str, np.ndarray], codebook: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The entry that owns each ball wholly (-1: none, or a ball above owns it) and the entries left to each leaf's points.

    All balls of a depth are looked at together, as pairs (ball, entry) that children inherit.
    """
    centres, radii = tree["centres"], tree["radii"]
    real = codebook.astype(np.float64)
    n_balls = len(radii)
    children = np.bincount(tree["parent"][1:], minlength=n_balls)
    first_child = np.full(n_balls, n_balls)
    np.minimum.at(first_child, tree["parent"][1:], np.arange(1, n_balls))
    owner = np.full(n_balls, -1)
    left: list[tuple[int, np.ndarray]] = []
    balls, lists = np.zeros(1, np.int64), [np.arange(len(codebook))]
    while len(balls):
        n = np.array([len(x) for x in lists])
        starts = np.cumsum(n) - n
        of, entries = np.repeat(np.arange(len(balls)), n), np.concatenate(lists)
        keep = np.ones(len(entries), dtype=bool)
        step = max(1, CHUNK // real.shape[1])
        d2 = np.empty(len(entries))
        for a in range(0, len(entries), step):
            d = centres[balls[of[a: a + step]]] - real[entries[a: a + step]]
            d2[a: a + step] = np.einsum("ij,ij->i", d, d)
        low = np.minimum.reduceat(d2, starts)
        hit = np.flatnonzero(d2 == low[of])
        best = entries[hit[np.concatenate(([True], of[hit][1:] != of[hit][:-1]))]]
        for a in range(0, len(entries), step):
            at = of[a: a + step]
            apart = _distances(real[entries[a: a + step]], real[best[at]])
            # the plane between an entry and the nearest one lies this far beyond the centre
            beyond = d2[a: a + step] - low[at]
            keep[a: a + step] = beyond <= 2 * apart * (radii[balls[at]] + 1e-6) * (1 + 1e-9) + 1e-9 * (low[at] + 1)
        of, entries = of[keep], entries[keep]
        counts = np.bincount(of, minlength=len(balls))
        lists = np.split(entries, np.cumsum(counts)[:-1])
        next_balls, next_lists = [], []
        for ball, entries in zip(balls.tolist(), lists):
            if len(entries) == 1:
                owner[ball] = entries[0]
            elif children[ball]:
                for child in (first_child[ball], first_child[ball] + 1):
                    next_balls.append(child)
                    next_lists.append(entries)
            else:
                left.append((ball, entries))
        balls, lists = np.array(next_balls, dtype=np.int64), next_lists
    return owner, left


def assigned(points: np.ndarray, weights: np.ndarray, tree: dict, codebook: np.ndarray, each: bool):
    """(count, sum) of each entry, from wholly owned balls' caches and from the points of the other leaves;
    with `each` also the (entry, squared distance) of every point."""
    owner, left = owned(points, tree, codebook)
    count = np.zeros(len(codebook), np.int64)
    sums = np.zeros(codebook.shape, np.int64)
    whole = np.flatnonzero(owner >= 0)
    np.add.at(count, owner[whole], tree["count"][whole])
    np.add.at(sums, owner[whole], tree["sums"][whole])
    entry, least = np.full(len(points), -1), np.zeros(len(points), np.int64)
    if left:
        lo, hi = tree["lo"], tree["hi"]
        places = np.concatenate([np.arange(lo[b], hi[b]) for b, _ in left])
        lists = [entries for b, entries in left for _ in range(hi[b] - lo[b])]
        entry[places], least[places] = nearest(points[places], lists, codebook)
        np.add.at(count, entry[places], weights[places])
        np.add.at(sums, entry[places], points[places] * weights[places][:, None])
    if each:
        for b in whole.tolist():
            at = slice(tree["lo"][b], tree["hi"][b])
            entry[at] = owner[b]
            d = points[at] - codebook[owner[b]]
            least[at] = np.einsum("ij,ij->i", d, d)
    return count, sums, entry, least


# -- Spark ------------------------------------------------------------------------------------------------------------

TREE = ("part int, width int, points array<int>, weights array<int>, place array<int>, lo array<int>, hi array<int>, "
        "depth array<int>, parent array<int>, count array<long>, sums array<long>")


def _blocks(rows: DataFrame, width: int, id_type: str, label_type: str) -> DataFrame:
    """One row per block: its ids and labels, and a tree per part; `place` is the point of each row."""
    size = width // PARTS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                b = batch.iloc[a: a + BLOCK]
                vectors = np.zeros((len(b), width), dtype=np.int64)
                for row, v in zip(vectors, b["v"]):
                    row[: len(v)] = v
                trees = []
                for p in range(PARTS):
                    points, place, weights = np.unique(
                        vectors[:, p * size: (p + 1) * size], axis=0, return_inverse=True, return_counts=True)
                    tree = ball_tree(points, weights)
                    order = tree["order"]
                    at = np.empty(len(order), np.int64)
                    at[order] = np.arange(len(order))
                    trees.append({"part": p, "width": size, "points": points[order].ravel(), "weights": weights[order],
                                  "place": at[place.ravel()], **{c: tree[c] for c in ("lo", "hi", "depth", "parent", "count")},
                                  "sums": tree["sums"].ravel()})
                yield pd.DataFrame({"ids": [b["vec_id"].tolist()], "labels": [b["label"].tolist()], "trees": [trees]})

    return rows.mapInPandas(run, f"ids array<{id_type}>, labels array<{label_type}>, trees array<struct<{_struct(TREE)}>>")


def _struct(columns: str) -> str:
    return ", ".join(c.strip().replace(" ", ":", 1) for c in columns.split(", "))


def _loaded(row) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Points, weights and tree of one part of one block."""
    width = int(row["width"])
    points = np.asarray(row["points"], dtype=np.int64).reshape(-1, width) if width else np.zeros((len(row["weights"]), 0), np.int64)
    tree = {c: np.asarray(row[c], dtype=np.int64) for c in ("lo", "hi", "depth", "parent", "count")}
    tree["sums"] = np.asarray(row["sums"], dtype=np.int64).reshape(len(tree["lo"]), width)
    tree["centres"], tree["radii"] = centres_and_radii(points, tree)
    return points, np.asarray(row["weights"], dtype=np.int64), tree


def _round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for trees in batch["trees"]:
                for t in trees:
                    points, weights, tree = _loaded(t)
                    count, sums, _, _ = assigned(points, weights, tree, codebooks[t["part"]], False)
                    used = np.flatnonzero(count)
                    yield pd.DataFrame({"part": t["part"], "entry": used, "n": count[used], "sums": list(sums[used])})

    found = blocks.select("trees").mapInPandas(run, "part int, entry int, n long, sums array<long>")
    size = codebooks.shape[2]
    # sums of a block are exact in 64 bits; those of all blocks are added as decimals, which do not overflow
    total = found.groupBy("part", "entry").agg(F.sum(F.col("n")).alias("n"), F.array(
        *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).cast("string") for i in range(size))).alias("sums"))
    out = codebooks.copy()
    for r in total.collect():  # PARTS * ENTRIES rows at every size
        out[r.part, r.entry] = [int(s) // r.n for s in r.sums]
    return out


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in codebooks.ravel().tolist()).encode()).hexdigest()


def _first(rows: DataFrame, n: int) -> list:
    """The first `n` rows by (vec_id, vector): the ids alone decide which rows are worth sending."""
    ids = [r.vec_id for r in rows.select("vec_id").orderBy(F.col("vec_id").asc_nulls_last()).limit(n).collect()]
    if not ids:
        return []
    within = F.lit(True) if ids[-1] is None else F.col("vec_id") <= F.lit(ids[-1])
    return rows.where(within).select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).collect()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256, and the label."""
    scratch = Scratch(vectors.sparkSession, "codes")
    label = F.col(f"`{label_col}`") if label_col in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), label.alias("label"), F.col(f"`{vector_col}`").alias("x")).where(
        usable(F.col("x"))).select("vec_id", "label", integers(F.col("x")).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    size = width // PARTS
    first = _first(rows, ENTRIES)
    codebooks = np.zeros((PARTS, len(first), size), dtype=np.int64)
    for i, r in enumerate(first):
        codebooks[:, i] = np.pad(np.array(r.v, dtype=np.int64), (0, width - len(r.v))).reshape(PARTS, size)
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    blocks = scratch.store(_blocks(rows, width, id_type, label_type))
    with arrow_rows(vectors.sparkSession, BLOCKS):
        for _ in range(ROUNDS if first else 0):
            codebooks = _round(blocks, codebooks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, labels, trees in zip(batch["ids"], batch["labels"], batch["trees"]):
                codes, error = [], 0
                for t in sorted(trees, key=lambda t: t["part"]):
                    points, weights, tree = _loaded(t)
                    _, _, entry, least = assigned(points, weights, tree, codebooks[t["part"]], True)
                    place = np.asarray(t["place"])
                    codes.append(entry[place])
                    error = error + least[place]
                text = np.stack(codes, axis=1).astype(np.uint8).tobytes().hex()
                yield pd.DataFrame({"vec_id": pd.Series(list(ids), dtype=object), "label": pd.Series(list(labels), dtype=object),
                                    "code": [text[i: i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], "error": error})

    with arrow_rows(vectors.sparkSession, BLOCKS):
        coded = scratch.store(blocks.mapInPandas(run, f"vec_id {id_type}, label {label_type}, code string, error long"))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"), "label")
