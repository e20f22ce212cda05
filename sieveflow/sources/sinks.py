"""Where results go, and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a session that runs on this machine alone; on a
    cluster every executor would write to a disk of its own, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sieveflow-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_matches(matches: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                  partition_by=()) -> None:
    """Write a match table, for instance with one folder per ruleset."""
    writer = matches.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def for_each_match(matches: DataFrame, handler) -> None:
    """Call ``handler(rows)`` once per partition, on the executors, with an iterator of rows.

    The handler stops early by returning before the iterator is used up.
    """
    matches.foreachPartition(handler)
