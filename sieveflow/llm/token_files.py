"""Token counts of flat token files: one number after the other, documents parted by an end-of-document id, no index.

Each file is cut into blocks of a fixed number of tokens. A block is searched for the separator at once
(numpy); what it hands on is its number of tokens and the places of separators. Documents that run over the end
of a block are stitched by a prefix scan over the blocks of a file: the last separator before a block, and the number
of documents before it, are running totals. No block is looked at twice and no file needs an index.

``write_token_files`` makes such files from a table of texts, one per partition of the table, without a shuffle:
Spark's text writer puts the separator's bytes after the bytes of each row.

A file is read as one value by Spark's reader for binary files, which works on every file system and limits a file to 2 GB,
so a corpus is many files. A file whose length is no whole number of tokens is refused.

Defined results: a document without tokens (NULL or empty text) counts 0. Tokens after the last separator of a
file are a document of their own that is marked as not ended; none after it are no document. Repeated rows are
documents each. An empty table or folder gives an empty table. Ids and other columns are not in the files.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import small_batches

BLOCK_TOKENS = 1 << 16
MAX_RANKS_BYTES = 32 << 20


def read_ranks(path: str) -> bytes:
    """A vocabulary of byte pairs, checked: it travels with every task."""
    with open(path, "rb") as f:
        ranks = f.read()
    if len(ranks) > MAX_RANKS_BYTES:
        raise ValueError(f"{path} is {len(ranks)} bytes; a vocabulary travels with each task and may have {MAX_RANKS_BYTES}")
    return ranks


def width(eod: int) -> int:
    """Bytes of a token in files whose largest id is the separator's."""
    return 2 if eod < 1 << 16 else 4


def write_token_files(docs: DataFrame, path: str, ranks: bytes, pattern: str, eod: int, text_col: str = "text") -> None:
    """Encode the texts of `docs` into flat files of little-endian tokens under `path`."""
    dtype = f"<u{width(eod)}"
    separator = np.array([eod], dtype=dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=pairs, special_tokens={})
        for b in batches:
            tokens = [np.array(encoding.encode_ordinary(t), dtype=dtype).tobytes() if t else b"" for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary())], ["tokens"])

    small_batches(docs).select(F.col(f"`{text_col}`")).mapInArrow(run, "tokens binary").select(F.col("tokens").cast("string")).write.option(
        "encoding", "ISO-8859-1").option("lineSep", separator.decode("ISO-8859-1")).text(path)


def scan_blocks(spark: SparkSession, path: str, eod: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, n, ends): of each block its number of tokens and the places of separators in it."""
    size = width(eod)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    whole = F.when(F.col("length") % size == 0, F.col("content")).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(" is no whole number of tokens"))))
    step = block_tokens * size
    blocks = files.where("length > 0").select(
        F.regexp_extract("path", r"[^/]+$", 0).alias("file"), whole.alias("content"),
        F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / step).cast("int"))).alias("block")).select(
        "file", "block", F.substring("content", F.col("block") * step + 1, F.lit(step)).alias("data"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tokens = [np.frombuffer(d, dtype=f"<u{size}") for d in b["data"]]
            yield pd.DataFrame({"file": b["file"], "block": b["block"], "n": [len(t) for t in tokens],
                                "ends": [np.flatnonzero(t == eod).astype(np.int32) for t in tokens]})

    return blocks.mapInPandas(run, "file string, block int, n int, ends array<int>")


def count_tokens(spark: SparkSession, path: str, eod: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: file_no, doc_no (both from 0, in file order), first_token, n_tokens, ended."""
    blocks = scan_blocks(spark, path, eod, block_tokens)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("block").cast("long") * block_tokens
    stitched = blocks.withColumns({
        "start": F.coalesce(F.last(base + F.try_element_at("ends", F.lit(-1)) + 1, ignorenulls=True).over(before), F.lit(0).cast("long")),
        "docs_before": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0).cast("long")),
        "is_last": F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull(),
    }).select("file", "start", "docs_before", base.alias("base"), (base + F.col("n")).alias("stop"), "ends", "is_last")
    # places where documents end; after the last separator of a file, its end
    ends = F.transform("ends", lambda e: F.struct((F.col("base") + e).alias("at"), F.lit(True).alias("ended")))
    open_end = F.when(F.col("is_last") & (F.col("stop") > F.coalesce(F.col("base") + F.try_element_at("ends", F.lit(-1)) + 1, F.col("start"))),
                      F.array(F.struct(F.col("stop").alias("at"), F.lit(False).alias("ended")))).otherwise(F.filter(ends, lambda e: F.lit(False)))
    docs = stitched.select("file", "start", "docs_before", F.concat(ends, open_end).alias("ends")).select(
        "file", "start", "docs_before", "ends", F.posexplode("ends").alias("i", "end"))
    first = F.when(F.col("i") == 0, F.col("start")).otherwise(F.get("ends", F.col("i") - 1)["at"] + 1)
    return docs.select(F.regexp_extract("file", r"^part-(\d+)", 1).cast("int").alias("file_no"),
                       (F.col("docs_before") + F.col("i")).alias("doc_no"), first.alias("first_token"),
                       (F.col("end.at") - first).alias("n_tokens"), F.col("end.ended").alias("ended"))
