"""Comparing rulesets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.flags import flag_bits

IDENTITY = ["ruleset", "rule_id", "pattern", "dialect", "flags"]


def normalized(rules: DataFrame) -> DataFrame:
    """Rules with their flags in one order, free of repeats and of NO_FLAG."""
    flags = F.array_sort(F.array_distinct(F.filter("flags", lambda f: f != "NO_FLAG")))
    return rules.withColumn("flags", flags).select(*IDENTITY)


def same_rules(left: DataFrame, right: DataFrame) -> bool:
    """Do two tables hold the same rules? Order of rules and of flags does not count."""
    a, b = normalized(left), normalized(right)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def same_rulesets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(ruleset, same): for each ruleset of either table, whether both have the same rules in it."""
    a, b = normalized(left), normalized(right)
    other = a.exceptAll(b).select("ruleset").unionAll(b.exceptAll(a).select("ruleset")).distinct().select(
        F.col("ruleset").alias("_set"), F.lit(False).alias("_same"))
    return a.select("ruleset").unionAll(b.select("ruleset")).distinct().join(
        other, F.col("ruleset").eqNullSafe(F.col("_set")), "left").select("ruleset", F.coalesce("_same", F.lit(True)).alias("same"))


def ruleset_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(rule_id, change, old_pattern, new_pattern): rules added, removed or changed."""
    a = normalized(old).select("ruleset", "rule_id", F.struct("pattern", "dialect", "flags").alias("old"))
    b = normalized(new).select("ruleset", "rule_id", F.struct("pattern", "dialect", "flags").alias("new"))
    both = a.alias("a").join(
        b.alias("b"),
        F.col("a.ruleset").eqNullSafe(F.col("b.ruleset")) & (F.col("a.rule_id") == F.col("b.rule_id")), "full")
    change = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
              .when(F.col("old") != F.col("new"), "changed"))
    return both.select(
        F.coalesce("a.rule_id", "b.rule_id").alias("rule_id"), change.alias("change"),
        F.col("old.pattern").alias("old_pattern"), F.col("new.pattern").alias("new_pattern"),
    ).where("change IS NOT NULL")


def rule_count(rules: DataFrame) -> int:
    return rules.count()


def rule_counts(rules: DataFrame) -> DataFrame:
    """(ruleset, n_rules)."""
    return rules.groupBy("ruleset").agg(F.count("*").alias("n_rules"))


def with_flag_bits(rules: DataFrame) -> DataFrame:
    return rules.withColumn("flag_bits", flag_bits(F.col("flags")))
