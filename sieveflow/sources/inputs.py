"""Inputs beside a plain string column."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns=None, **options) -> DataFrame:
    """A table of any Spark format, narrowed to the columns a scan needs."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*columns) if columns else df


def spread_small_input(df: DataFrame) -> DataFrame:
    """Give every core a share of an input with fewer splits than cores.

    Matching is bound by CPU, and a file that is one row group is one task however long its
    texts are. Only such small inputs are shuffled; anything larger is returned as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores * 2)


def read_blobs(spark: SparkSession, path: str, **options) -> DataFrame:
    """Whole files as rows (path, content) for a byte scan."""
    return spark.read.format("binaryFile").options(**options).load(path).select("path", "content")


def byte_slice(data: Column, position: int | Column, remaining: int | Column) -> Column:
    """`remaining` bytes from 0-based `position`; offsets of a scan count from the slice."""
    position = F.lit(position) if isinstance(position, int) else position
    remaining = F.lit(remaining) if isinstance(remaining, int) else remaining
    return F.substring(data, position + 1, remaining)
