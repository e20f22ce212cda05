"""Rules as a table: construction, reading, saving."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..functions.flags import java_flag_names
from ..schemas import DIRECT, FLAG_BITS, JAVA, RULES


def rule(pattern: str, flags: str | Iterable[str] = (), rule_id: int | None = None,
         ruleset: str | None = None, dialect: str = DIRECT) -> dict:
    """One rule. `flags` is a flag name or several; no id means its position in the set."""
    if pattern is None or flags is None:
        raise ValueError("pattern and flags must not be None")
    names = [flags] if isinstance(flags, str) else list(flags)
    if any(n is None for n in names):
        raise ValueError("flags must not be None")
    if dialect == DIRECT and (unknown := sorted(set(names) - set(FLAG_BITS))):
        raise ValueError(f"unknown flags {unknown}")
    if rule_id is not None and rule_id < 0:
        raise ValueError(f"rule id must not be negative: {rule_id}")
    return {"rule_id": rule_id, "pattern": pattern, "flags": names or ["NO_FLAG"],
            "dialect": dialect, "ruleset": ruleset}


def rules_table(spark: SparkSession, rules: Iterable[dict | str]) -> DataFrame:
    """A rules table from rules (or bare patterns) held by the caller."""
    rows = [r if isinstance(r, dict) else rule(r) for r in rules]
    return spark.createDataFrame([
        (r["rule_id"], r["pattern"], r["flags"], r["dialect"], r["ruleset"], i)
        for i, r in enumerate(rows)], RULES)


def rules_from_df(df: DataFrame) -> DataFrame:
    """Any table with a `pattern` column as a rules table; absent columns take defaults."""
    def column(name: str, default: Column) -> Column:
        return F.col(name) if name in df.columns else default

    return df.select(
        column("rule_id", F.lit(None)).cast("int").alias("rule_id"),
        F.col("pattern"),
        column("flags", F.array(F.lit("NO_FLAG"))).alias("flags"),
        column("dialect", F.lit(DIRECT)).alias("dialect"),
        column("ruleset", F.lit(None)).cast("string").alias("ruleset"),
        column("pos", F.lit(None)).cast("int").alias("pos"))


def rules_from_regex(df: DataFrame, pattern_col: str = "pattern", java_flags_col: str | None = None,
                     id_col: str | None = None) -> DataFrame:
    """Java regexes with their integer option bits as a rules table (``dialect='java'``)."""
    bits = F.col(java_flags_col) if java_flags_col else F.lit(0)
    return rules_from_df(df.select(
        *([F.col(id_col).alias("rule_id")] if id_col else []),
        F.col(pattern_col).alias("pattern"),
        java_flag_names(bits).alias("flags"),
        F.lit(JAVA).alias("dialect"),
        *([F.col("pos")] if "pos" in df.columns else []),
        *([F.col("ruleset")] if "ruleset" in df.columns else [])))


def with_positional_ids(rules: DataFrame) -> DataFrame:
    """Rules without ids are numbered 0, 1, … by `pos`, within their ruleset.

    Every such rule needs a `pos` of its own, or its number would differ from run to run.
    """
    sets = rules.groupBy("ruleset").agg(
        F.count("*").alias("n"), F.count_distinct("pos").alias("places"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
        F.count_if(F.col("rule_id").isNull()).alias("unnamed"))
    numbers = dict(rules.dtypes)["pos"] in ("int", "bigint")
    gaps = F.count_if((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1)) if numbers else F.lit(1)
    whole = sets.agg(F.count_if((F.col("unnamed") > 0) & (F.col("places") < F.col("n"))).alias("bad"),
                     gaps.alias("gaps")).first()
    if whole.bad:
        raise ValueError("rules without ids are numbered by `pos`, which must be present and differ within a ruleset")
    # places without gaps are the numbers themselves
    position = F.row_number().over(Window.partitionBy("ruleset").orderBy("pos")) - 1 if whole.gaps else F.col("pos")
    return rules.withColumn("rule_id", F.coalesce("rule_id", position).cast("int"))


def save_rules(rules: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a rules table. A missing id stays missing."""
    rules.select(*RULES.fieldNames()).write.mode(mode).parquet(path)


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved rules table; compile it to check and use it."""
    return spark.read.schema(RULES).parquet(path)
