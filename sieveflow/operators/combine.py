"""Logical combinations of rule hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import one_row_each
from ..plans.compiled import CompiledRules
from .hits import HITS, as_list, with_hits
from .scan import MATCHES, combination_condition, combination_matches, matches_per_text, rule_ids, with_traits


def rule_hits_per_text(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=()) -> DataFrame:
    """One row per text, matched or not, with the sorted ids of the rules that hit it."""
    keep = [*as_list(key), *keep]
    found = with_hits(docs, compiled, text, keep)
    return found.select(*keep, F.array_sort(F.transform(HITS, lambda r: r["rule_id"])).alias("hits"))


def combinations(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=(),
                 with_ruleset: bool = False) -> DataFrame:
    """One row (key, rule_id) per combination that holds for a text.

    A text that no rule hits takes part: a combination of negations holds for it.
    """
    keep = [*as_list(key), *keep]
    found = with_hits(docs, compiled, text, keep).select(*keep, rule_ids(F.col(HITS)).alias("_ids"))
    return one_row_each(found, keep, combination_matches(compiled), "m").select(
        *keep, *(["m.ruleset"] if with_ruleset else []), "m.rule_id")


def combination_events(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=(), offset_unit: str = "utf16",
                       with_ruleset: bool = False) -> DataFrame:
    """(key, rule_id, end, holds): where in a text a combination begins or ceases to hold.

    A text is swept by ends: a rule counts from the end of its first match on, quiet or not. An event without an
    end is a combination that holds before anything is read, such as one of negations.
    """
    keep = [*as_list(key), *keep]
    first = with_traits(compiled, combinations=[], single=True, quiet=False)
    found = matches_per_text(docs, first, key, text, keep[len(as_list(key)):], offset_unit).select(*keep, F.transform(
        MATCHES, lambda m: F.struct(F.concat_ws("#", m["ruleset"], m["rule_id"].cast("string")).alias("id"), m["end"].alias("end"))).alias("_first"))

    def ids(within) -> Column:
        return F.transform(F.filter("_first", within), lambda f: f["id"])

    ends = F.concat(F.array(F.lit(None).cast("bigint")), F.array_sort(F.array_distinct(F.transform("_first", lambda f: f["end"]))))
    places = F.transform(F.when(F.col("_first").isNotNull(), ends), lambda e: F.struct(
        e.alias("end"), ids(lambda f: f["end"] <= e).alias("now"), ids(lambda f: f["end"] < e).alias("before")))
    swept = one_row_each(found, keep, places, "_at").select(
        *keep, F.col("_at.end").alias("_end"), F.col("_at.now").alias("_now"), F.col("_at.before").alias("_before"))

    def event(c) -> Column:
        holds = F.expr(combination_condition(c.pattern, c.ruleset, "_now"))
        held = F.when(F.col("_end").isNotNull(), F.expr(combination_condition(c.pattern, c.ruleset, "_before"))).otherwise(F.lit(False))
        return F.when(holds != held, F.struct(
            F.lit(c.ruleset).cast("string").alias("ruleset"), F.lit(c.rule_id).alias("rule_id"), F.col("_end").alias("end"), holds.alias("holds")))

    events = F.array_compact(F.array(*[event(c) for c in compiled.combinations if not c.quiet]))
    if not any(not c.quiet for c in compiled.combinations):
        events = F.from_json(F.lit("[]"), "array<struct<ruleset:string,rule_id:int,end:bigint,holds:boolean>>")
    return one_row_each(swept, keep, events, "m").select(
        *keep, *(["m.ruleset"] if with_ruleset else []), "m.rule_id", "m.end", "m.holds")
