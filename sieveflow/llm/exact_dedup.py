"""Exact duplicates by content sort.

Sampled splitters range-partition the texts by their normalised bytes, an external sort puts
equal texts next to each other, and each row is compared in full with the one before it.
Only built-in functions are used.

* The sort key is the first bytes of the text, then a digest of the whole for texts that
  begin alike, so the splitters that travel to the driver stay short however long texts are.
* A fixed number of salts (from the id) comes last in the key. A text that makes up a third of
  all rows is thereby cut into many runs in adjacent ranges.
* What is equal is said by the comparison of neighbours: it numbers the different texts of a run, and a group's size and
  the id that stays are those of its numbers. One narrow row per run and number is left, and these are joined by two
  digests of the text.

Defined results: a NULL text counts as empty; empty texts equal each other. A NULL id ranks
after any other id and is never preferred. Of rows that repeat id and text, the one whose whole row has the least hash is kept.
An empty table gives an empty table. Other columns, whatever their names, pass through
``drop_copies`` and are ignored by ``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch, fold_ascii, row_hash

KEY_BYTES = 32
SALTS = 64
KEY = ("__head", "__digest", "__salt")


def _digest(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, keep: str, payload: dict[str, Column]) -> DataFrame:
    """`payload` with ``__id``, ``__digest``, ``__more`` (another digest), ``__salt``, whether the row before holds the
    same text (``__again``) and the number of the text in its run (``__no``). Within a text the preferred id comes first."""
    norm = fold_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), norm.alias("__norm"), row_hash(docs).alias("__tie"),
                       *(c.alias(n) for n, c in payload.items()))
    keyed = rows.withColumns({
        "__head": F.substring(F.col("__norm").cast("binary"), 1, KEY_BYTES),
        "__digest": F.unhex(_digest(F.col("__norm"))),
        "__more": F.xxhash64("__norm"),
        "__salt": F.pmod(F.xxhash64("__id"), F.lit(SALTS)),
    })
    preferred = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()
    # the window's keys are those of the range partitioning, so the texts are not shuffled again
    run = Window.partitionBy(*KEY).orderBy("__norm", preferred, "__tie")
    compared = keyed.repartitionByRange(*KEY).withColumn("__again", F.coalesce(F.col("__norm") == F.lag("__norm").over(run), F.lit(False)))
    # the same order, so nothing is sorted again
    sofar = run.rowsBetween(Window.unboundedPreceding, 0)
    return compared.withColumn("__no", F.sum(F.when(F.col("__again"), 0).otherwise(1)).over(sofar)).drop("__norm")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. `keep` ("smallest" or "largest")
    says which id of a group stays.
    """
    spark = docs.sparkSession
    best = F.max if keep == "largest" else F.min
    rows = Scratch(spark, "exact").store(
        _sorted_runs(docs, id_col, text_col, keep, {}).select("__id", "__digest", "__more", "__salt", "__no", "__again"))
    runs = rows.groupBy("__digest", "__salt", "__no").agg(
        F.count("*").alias("n"), best("__id").alias("best"), F.min("__more").alias("__more"))
    totals = runs.groupBy(F.col("__digest").alias("digest"), F.col("__more").alias("more")).agg(
        F.sum("n").alias("group_size"), best("best").alias("keep_id"))
    runs = runs.join(totals, (F.col("__digest") == F.col("digest")) & (F.col("__more") == F.col("more"))).select(
        "digest", F.col("__salt").alias("salt"), F.col("__no").alias("no"), "keep_id", "group_size")
    return rows.join(runs, (F.col("__digest") == F.col("digest")) & (F.col("__salt") == F.col("salt")) & (F.col("__no") == F.col("no"))).select(
        F.col("__id").alias("doc_id"), "keep_id", "group_size",
        (F.col("__id").eqNullSafe(F.col("keep_id")) & ~F.col("__again")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of `docs`, all columns as they are, without those whose text another kept row has."""
    firsts = _sorted_runs(docs, id_col, text_col, keep, {"__row": F.struct("*")}).where(~F.col("__again"))
    preferred = F.col("__id").desc_nulls_last() if keep == "largest" else F.col("__id").asc_nulls_last()
    # at most SALTS rows per text are left
    group = Window.partitionBy("__digest", "__more").orderBy(preferred, "__tie")
    return firsts.withColumn("__rank", F.row_number().over(group)).where("__rank = 1").select("__row.*")
