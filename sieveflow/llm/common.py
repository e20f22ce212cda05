"""Helpers that several corpus operators share."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# a word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """`text` with A-Z in lower case and nothing else changed.

    ``lower`` has a fast path for ASCII but also folds other letters, so it only serves
    texts of one byte per character.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor of a cluster sees.

    Where that is unset (local tests) a temporary folder of this machine is set as the
    session's checkpoint folder; on a cluster that would not do, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def small_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """`df`, whose session hands at most `rows` rows at a time to Python: whole texts are long, and by
    default 10,000 of them are one batch, held by the executor and by its Python worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key))
    if not 0 < now <= rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def row_hash(df: DataFrame, packed: str | None = None) -> Column:
    """A hash of a whole row of `df` (or of the struct column `packed` that holds it): of rows that tie in all that
    matters, the one of least hash is taken, on every run the same. Map columns, which have no hash, are left out."""
    names = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(0), *(F.col(f"`{n}`") if packed is None else F.col(packed).getField(n) for n in names))


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first `n` rows of `df` by a hash of `key`.

    A limit alone would send `n` rows of every partition on; a threshold from the number of rows lets
    about `n` through in all.
    """
    h = F.xxhash64(key)
    total = df.count()
    if total > n:
        # a little more than the share that is wanted, so that the limit decides
        df = df.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int((1 << 30) * (n + 8 * n ** 0.5) / total) + 1))
    return df.orderBy(h, key).limit(n)


FILTER_BITS = 1 << 20


def may_hold(keys: DataFrame, key: str):
    """A test of fixed size, to be asked of another table's column before it is joined with `keys`: false only for keys
    that are not there."""
    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("string")), F.lit(FILTER_BITS))

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place(c) % 64).cast("int"))

    words = keys.groupBy(F.floor(place(F.col(key)) / 64).cast("int").alias("w")).agg(F.bit_or(bit(F.col(key))).alias("bits")).collect()
    bits = [0] * (FILTER_BITS // 64)
    for r in words:
        bits[r.w] = r.bits
    table = F.from_json(F.lit(json.dumps(bits)), "array<bigint>")
    return lambda c: F.get(table, F.floor(place(c) / 64).cast("int")).bitwiseAND(bit(c)) != 0


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs hand at most `rows` rows at a time to Python; afterwards the session is as it was.

    For tables whose rows are whole blocks. Jobs that run later do not see it, so results are stored within.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# for tables whose rows are MB: Parquet's writer looks at a page's size after 100 rows only, so that all of a task's rows are one page,
# and a page is packed and unpacked in buffers outside the heap that stay with the executor
A_ROW_A_PAGE = {"parquet.page.size.row.check.min": "1", "parquet.page.row.count.limit": "1"}


class Scratch:
    """Tables written to the shared folder to cut lineage: read back after an executor is lost."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, shared_folder(spark, name), 0

    def store(self, df: DataFrame, **options: str) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
