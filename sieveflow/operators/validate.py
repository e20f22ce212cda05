"""Rule and ruleset checks. `rlike` with a bad pattern fails the job, so these run first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from ..functions.flags import has_flag, regex_options, unknown_flags
from ..functions.syntax import java_source, java_tokens, merged_repeats, refused_construct, tokens
from ..schemas import DIRECT


class RuleError(ValueError):
    """A rule that cannot be used; `failed_rules` lists (rule_id, pattern, message).

    Of a ruleset beyond the size bound these are some of `n_failed`, and `table` has all as rows.
    """

    def __init__(self, failed_rules, n_failed: int | None = None, table: DataFrame | None = None):
        self.failed_rules, self.table = failed_rules, table
        self.n_failed = len(failed_rules) if n_failed is None else n_failed
        more = self.n_failed - len(failed_rules)
        super().__init__("; ".join(f"rule {i} {p!r}: {m}" for i, p, m in failed_rules) + (f"; and {more} more, see table" if more else ""))


def compiles(regex: Column) -> Column:
    """Is this a well-formed Java regex?"""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), regex).isNotNull()


def nullable_rule(source: Column, flags: Column, dialect: Column) -> Column:
    """Can a (well-formed) rule match the empty text?"""
    options = regex_options(flags, dialect)
    return F.rlike(F.lit(""), F.concat(F.lit(r"\A(?"), options, F.lit(":"), source, F.lit(r")\z")))


def _well_formed_combination(expression: Column) -> Column:
    """Does `expression` reduce to one operand under ``!``, ``&``, ``|`` and brackets?"""
    x = F.regexp_replace(F.regexp_replace(expression, r"(?<!\d)\d+(?!\d)", "n"), r"(?<!n)\s+|\s+(?!n)", "")

    def step(acc: Column, _: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(acc, r"!n|\(n\)", "n"), r"n(?:[&|]n)+", "n")

    # every step but the last shortens it, so there is no deeper nesting than its length
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1))), x, step) == "n"


def rule_error(pattern: Column, flags: Column, dialect: Column) -> Column:
    """Why a rule cannot be used, or NULL if it can."""
    def regex_error(toks: Column) -> Column:
        source = java_source(java_tokens(toks, dialect), dialect)
        direct = dialect == DIRECT
        return (
            F.when(direct & ~has_flag(flags, "PREFILTER") & refused_construct(toks).isNotNull(),
                   refused_construct(toks))
            # the bare regex: inside a group, `a)(b` would look well-formed
            .when(~compiles(F.when(has_flag(flags, "COMMENTS"), F.concat(F.lit("(?x)"), source))
                            .otherwise(source)), F.lit("not a well-formed regex"))
            .when(direct & ~has_flag(flags, "ALLOWEMPTY") & nullable_rule(source, flags, dialect),
                  F.lit("matches the empty text, which needs ALLOWEMPTY")))

    return (
        F.when(pattern.isNull() | flags.isNull(), F.lit("pattern and flags must not be null"))
        .when(F.size(unknown_flags(flags, dialect)) > 0, F.lit("unknown flag"))
        .when(has_flag(flags, "CANON_EQ"), F.lit("CANON_EQ has no inline option and cannot be kept"))
        .when(has_flag(flags, "COMBINATION"), F.when(
            ~_well_formed_combination(pattern), F.lit("not a well-formed combination")))
        .when(has_flag(flags, "LITERAL"), F.lit(None))
        .otherwise(let(tokens(pattern), regex_error)))


def slow_rule_hint(pattern: Column) -> Column:
    """A quantified group that itself ends in a quantifier: may backtrack without end."""
    return F.rlike(pattern, F.lit(r"[*+]\)(?:[*+]|\{\d+,\d*\})"))


def set_apart_slow(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rules table without those that may take exponential time, and these with a `reason`.

    Nested repeats that compiling makes one (see `merged_repeats`) are no reason.
    """
    toks = merged_repeats(java_tokens(tokens(F.col("pattern")), F.col("dialect")))
    plain = F.array_contains("flags", "LITERAL") | F.array_contains("flags", "COMBINATION")
    marked = rules.withColumn("reason", F.when(~plain & slow_rule_hint(F.array_join(toks, "")), F.lit("a repeated group ends in a repeat")))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def validate_rules(rules: DataFrame) -> DataFrame:
    """rule_id, pattern, is_valid, error: one row per rule."""
    error = rule_error(F.col("pattern"), F.col("flags"), F.col("dialect"))
    return rules.select("rule_id", "pattern", error.alias("error")).select(
        "rule_id", "pattern", F.col("error").isNull().alias("is_valid"), "error")


def duplicate_ids(rules: DataFrame) -> DataFrame:
    return (rules.where(F.col("rule_id").isNotNull()).groupBy("ruleset", "rule_id").count()
            .where("count > 1"))


def ruleset_summary(rules: DataFrame) -> DataFrame:
    """One row: number of rules, ids, distinct ids, least id and text size."""
    return rules.agg(
        F.count("*").alias("n_rules"),
        F.count("rule_id").alias("n_ids"),
        F.count_distinct(F.when(F.col("rule_id").isNotNull(), F.struct("ruleset", "rule_id"))).alias("n_distinct"),
        F.min("rule_id").alias("min_id"),
        F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0)).alias("n_bytes"))


def check_ruleset(rules: DataFrame, allow_empty: bool = False):
    """Raise if the set is empty, or its ids are mixed, duplicate or negative.

    Returns the summary row, which costs one pass over the rules.
    """
    s = ruleset_summary(rules).first()
    if s.n_rules == 0 and not allow_empty:
        raise ValueError("the ruleset is empty")
    if s.n_ids not in (0, s.n_rules):
        raise ValueError("either all rules have an id or none has")
    if s.min_id is not None and s.min_id < 0:
        raise ValueError(f"rule id must not be negative: {s.min_id}")
    if s.n_distinct != s.n_ids:
        repeated = duplicate_ids(rules)
        some = [r.rule_id for r in repeated.limit(10).collect()]
        raise ValueError(f"{repeated.count()} duplicate rule ids, such as {some}; duplicate_ids() has all")
    return s


def ruleset_problems(rules: DataFrame) -> DataFrame:
    """(ruleset, problem, n): what :func:`check_ruleset` would refuse, for each ruleset of a table by itself.

    `n` is the number of rules without an id, with a negative one, or that repeat one.
    """
    repeated = duplicate_ids(rules).groupBy("ruleset").agg(F.sum(F.col("count") - 1).alias("repeats")).withColumnRenamed("ruleset", "_set")
    counted = rules.groupBy("ruleset").agg(
        F.count_if(F.col("rule_id").isNull()).alias("unnamed"), F.count("rule_id").alias("named"), F.count_if(F.col("rule_id") < 0).alias("negative"))
    found = counted.join(repeated, F.col("ruleset").eqNullSafe(F.col("_set")), "left")

    def problem(name: str, n: Column) -> Column:
        return F.when(n > 0, F.struct(F.lit(name).alias("problem"), n.cast("bigint").alias("n")))

    problems = F.array_compact(F.array(
        problem("some rules have an id and some have none", F.when(F.col("named") > 0, F.col("unnamed"))),
        problem("negative rule id", F.col("negative")), problem("duplicate rule ids", F.col("repeats"))))
    return found.select("ruleset", F.explode(problems).alias("p")).select("ruleset", "p.problem", "p.n")
