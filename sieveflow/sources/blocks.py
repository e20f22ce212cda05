"""Files of any size as tables of overlapping blocks of bytes.

Spark's text reader cuts a file at a separator and reads its splits side by side, so no file and no split is ever one
value. The place of each piece in its file is a running total, first of a split's pieces, then of a file's splits;
pieces are then cut and joined to blocks of a fixed number of bytes, each with some bytes of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK_BYTES = 1 << 20
BYTE_ORDER_MARK = "EFBBBF"


def _located(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(path, size, start, data): the pieces of each file, separators included."""
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", separator).text(path).select(
        meta["file_path"].alias("path"), meta["file_size"].alias("size"), meta["file_block_start"].alias("split"),
        F.monotonically_increasing_id().alias("n"), F.concat(F.col("value").cast("binary"), F.lit(separator.encode())).alias("data"))
    length = F.octet_length("data").cast("long")
    splits = pieces.groupBy("path", "split").agg(F.sum(length).alias("bytes"))
    of_file = Window.partitionBy("path")
    earlier = of_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "split", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"), F.sum("bytes").over(of_file).alias("total"))
    before = Window.partitionBy("path", "split").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("inside", F.coalesce(F.sum(length).over(before), F.lit(0))).join(splits, ["path", "split"])
    # the reader drops a byte order mark at the start of a file, and the end of the last piece may be no separator
    mark = F.col("size") - F.col("total") >= 2
    first = (F.col("base") + F.col("inside")) == 0
    start = F.col("base") + F.col("inside")
    return placed.select(
        "path", "size", F.when(mark & ~first, start + 3).otherwise(start).alias("start"),
        F.when(mark & first, F.concat(F.unhex(F.lit(BYTE_ORDER_MARK)), F.col("data"))).otherwise(F.col("data")).alias("data"))


def read_byte_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, before: int = 0, after: int = 0,
                     separator: str = "\n") -> DataFrame:
    """(path, block, at, data): block k has the bytes from k * block_bytes, with `before` and `after` bytes more on either side.

    `at` is the place of its first byte in the file. All bytes of a file are there whatever they are; `separator`, one
    ASCII character, should occur now and then, as a stretch without it is one value of at most 2 GB.
    """
    pieces = _located(spark, path, separator)
    start, stop = F.col("start"), F.least(F.col("start") + F.octet_length("data"), "size")

    def block_of(at: Column) -> Column:
        return F.floor(at / block_bytes).cast("long")

    first = block_of(F.greatest(start - after, F.lit(0)))
    last = block_of(F.least(stop - 1 + before, F.col("size") - 1))
    parts = pieces.where(stop > start).select(
        "path", "size", start.alias("start"), stop.alias("stop"), "data", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("block") * block_bytes - before, F.lit(0))
    hi = F.least((F.col("block") + 1) * block_bytes + after, "size")
    a, b = F.greatest(F.col("start"), lo), F.least(F.col("stop"), hi)
    cut = parts.where(a < b).select("path", "block", F.struct(
        a.alias("at"), F.substring("data", (a - F.col("start") + 1).cast("int"), (b - a).cast("int")).cast("string").alias("s")).alias("p"))
    # a block's pieces are bounded by its size
    return cut.groupBy("path", "block").agg(F.array_sort(F.collect_list("p")).alias("p")).select(
        "path", "block", F.element_at("p", 1)["at"].alias("at"),
        F.array_join(F.transform("p", lambda p: p["s"]), "").cast("binary").alias("data"))
