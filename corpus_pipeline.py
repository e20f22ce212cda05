"""The corpus pipeline: documents in, token ids of the cleaned and mixed corpus out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveflow.llm.common import Scratch, table
from sieveflow.llm.exact_dedup import drop_copies
from sieveflow.llm.mixing import mixed
from sieveflow.llm.pieces import encode, read_model
from sieveflow.llm.queries import PIECES
from sieveflow.llm.simhash import MAX_BITS, SHINGLE, drop_near_copies
from sieveflow.llm.toxicity import drop_toxic, fit


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores as toxic go."""
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts stays: that of the largest doc_id."""
    return drop_copies(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (op7's shingle length and bit distance) stays: that of the smallest doc_id."""
    return drop_near_copies(docs, size=SHINGLE, max_bits=MAX_BITS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of each row."""
    return encode(docs, read_model(PIECES)).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

# learned scores, SimHash, random rounding and subword encoding have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
