"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words, so every document of a source is to be taken
target / size of the source times on average: a whole number of copies and a fraction. The
fractions are rounded in pairs. Of two documents, words of probability mass go from one to
the other until one of them is taken or left out for certain; which way they go is drawn so
that neither's expectation changes. The sum of words is kept exactly, so after all pairs a
source misses its target by at most half the size of one document.

Pairs are formed in blocks of about `FAN` documents of a source; each block leaves one undecided
document, and these are combined in blocks again: a reduction tree whose levels shrink by `FAN`.
A source with a third of all rows is so many blocks, spread over all tasks. Only built-in
functions are used; draws are hashes of the documents' keys, so reruns agree.

Targets: sources in code-point order (NULL last) get weights that repeat, and share a
multiple of all words. A target stops at `max_copies` times its source; the rest is shared anew
until none is above. Only a few sums per round come to the driver.

Defined results: a NULL text has no words and is taken 0 words whatever its copies. NULL is a
source of its own. Rows that repeat id, source and text are one unit whose copies are dealt to
them as evenly as possible. An empty table gives an empty table. Other columns are ignored
by ``mix`` and kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch, WORD, row_hash

FAN = 64
SEED = 42
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2


def _units(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("text_key"),
    ).groupBy("doc_id", "source", "size", "text_key").agg(F.count("*").alias("n_rows"))


def _ranked_sources(units: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, source_size, n_units, rank): a sort over all partitions, offset by their counts."""
    order = F.col("source").asc_nulls_last()
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count("*").alias("n_units"))
    placed = scratch.store(sources.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    # one row per partition
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(parts, F.col("part") == F.col("p")).select(
        "source", "source_size", "n_units", (F.col("at") - F.col("first") + F.col("offset")).alias("rank"))


def source_targets(units: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, rank, source_size, n_units, target, rate)."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = scratch.store(_ranked_sources(units, scratch).withColumn("weight", weight))
    cap = F.col("source_size") * float(max_copies)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, n_above = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        n, capped, free = sources.agg(
            F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == n_above or not free:
            break
        n_above = n
        level = (share * total - (capped or 0.0)) / free
    above = F.col("weight") * F.lit(level) > cap
    target = F.when(above, cap).otherwise(F.col("weight") * F.lit(level))
    return sources.select(
        "source", "rank", "source_size", "n_units", target.alias("target"),
        F.when(above | (F.col("source_size") == 0), F.lit(float(max_copies))).otherwise(
            F.least(F.lit(float(max_copies)), target / F.col("source_size"))).alias("rate"))


def _draw(*keys: Column) -> Column:
    """A number in [0, 1) from the hash of `keys`."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *keys), 11) / F.lit(float(1 << 53))


def _meet(a: Column, b: Column, level: int) -> Column:
    """Two undecided units -> struct(rest, decided unit)."""
    mass_a, mass_b = a["p"] * a["size"], b["p"] * b["size"]
    room_a, room_b = (1.0 - a["p"]) * a["size"], (1.0 - b["p"]) * b["size"]
    to_b, to_a = F.least(mass_a, room_b), F.least(room_a, mass_b)
    gives = _draw(F.lit(level), a["doc_id"], a["text_key"], b["doc_id"], b["text_key"]) * (to_b + to_a) < to_a

    def outcome(rest: Column, p: Column, decided: Column, taken: int) -> Column:
        return F.struct(rest.withField("p", p).alias("rest"), decided.withField("p", F.lit(float(taken))).alias("decided"))

    return (F.when(gives & (mass_a <= room_b), outcome(b, b["p"] + mass_a / b["size"], a, 0))
             .when(gives, outcome(a, a["p"] - room_b / a["size"], b, 1))
             .when(room_a <= mass_b, outcome(b, b["p"] - room_a / b["size"], a, 1))
             .otherwise(outcome(a, a["p"] + mass_b / a["size"], b, 0)))


def _reduce_block(units: Column, level: int) -> Column:
    """An array of units -> struct(rest, decided units): each meets what is left of those before."""
    def merge(acc: Column, unit: Column) -> Column:
        met = F.transform(F.array(_meet(acc["rest"], unit, level)), lambda m: F.struct(
            m["rest"].alias("rest"), F.concat(acc["decided"], F.array(m["decided"])).alias("decided")))
        return F.element_at(met, 1)

    first = F.struct(F.element_at(units, 1).alias("rest"), F.filter(units, lambda u: F.lit(False)).alias("decided"))
    return F.aggregate(F.slice(units, 2, F.size(units)), first, merge)


def _decisions(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, max_copies) -> DataFrame:
    """One row per unit: doc_id, source, size, text_key, n_rows, source_size, target and the copies of all its rows."""
    scratch = Scratch(docs.sparkSession, "mix")
    units = scratch.store(_units(docs, id_col, text_col, source_col))
    targets = scratch.store(source_targets(units, scratch, weights, share, max_copies).withColumnRenamed("source", "of"))
    n_blocks = F.ceil(F.col("n_units") / FAN)
    # no hint: Spark broadcasts the targets if their table is small enough, and else splits hot sources
    rated = units.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumns({
        "wanted": F.col("rate") * F.col("n_rows")}).select(
        F.pmod(F.xxhash64("doc_id", "text_key"), n_blocks).alias("block"),
        F.struct("doc_id", "source", "size", "text_key", "n_rows", "source_size", "target", "rank",
                 F.floor("wanted").alias("whole"), (F.col("wanted") - F.floor("wanted")).alias("p")).alias("u"))
    open_ = (F.col("u.p") > 0) & (F.col("u.size") > 0)
    done = [rated.where(~open_).select("u")]
    level, last = 0, rated.where(open_)
    while True:
        blocks = last.groupBy(F.col("u.rank").alias("rank"), "block").agg(F.collect_list(F.struct(
            F.xxhash64("u.doc_id", "u.text_key").alias("key"), F.col("u.doc_id").alias("id"), "u")).alias("us"))
        blocks = scratch.store(blocks.select("rank", "block", F.transform(F.array_sort("us"), lambda x: x["u"]).alias("us"))
                               .select("rank", "block", _reduce_block(F.col("us"), level).alias("b")))
        done.append(blocks.select(F.explode("b.decided").alias("u")))
        last = blocks.select(F.floor(F.col("block") / FAN).alias("block"), F.col("b.rest").alias("u"))
        if blocks.where("block > 0").isEmpty():
            break
        level += 1
    done.append(last.select("u"))
    # what is left over of a source goes to the nearer side; units without words are drawn on their own
    bound = F.when(F.col("u.size") > 0, F.lit(0.5)).otherwise(1.0 - _draw(F.lit(-1), F.col("u.doc_id"), F.col("u.text_key")))
    taken = (F.col("u.p") >= bound).cast("int")
    return reduce(DataFrame.unionByName, done).select(
        "u.doc_id", "u.source", "u.size", "u.text_key", "u.n_rows", "u.source_size", "u.target",
        (F.col("u.whole") + taken).alias("unit_copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words), copies."""
    units = _decisions(docs, id_col, text_col, source_col, weights, share, max_copies)
    rows = units.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("nth"))
    copies = F.floor(F.col("unit_copies") / F.col("n_rows")) + (
        F.col("nth") <= F.col("unit_copies") % F.col("n_rows")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mix itself: each row of `docs`, all columns as they are, as often as it is taken."""
    chosen = _decisions(docs, id_col, text_col, source_col, weights, share, max_copies).where("unit_copies > 0").select(
        F.col("doc_id").alias("__i"), F.col("source").alias("__s"), F.col("text_key").alias("__k"), "n_rows", "unit_copies")
    rows = docs.select(F.struct("*").alias("__row"), F.col(f"`{id_col}`").alias("__id"), F.col(f"`{source_col}`").alias("__source"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("__key"))
    joined = rows.join(chosen, F.col("__id").eqNullSafe(F.col("__i")) & F.col("__source").eqNullSafe(F.col("__s"))
                       & (F.col("__key") == F.col("__k")))
    # of rows that repeat id, source and text the one of least hash stands for all
    single = joined.where("n_rows = 1")
    repeated = joined.where("n_rows > 1").groupBy("__id", "__source", "__key").agg(
        F.min_by("__row", row_hash(docs, "__row")).alias("__row"), F.max("unit_copies").alias("unit_copies"))
    return reduce(DataFrame.unionByName, [
        part.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("unit_copies"))).alias("__nth")).select("__row.*")
        for part in (single, repeated)])
