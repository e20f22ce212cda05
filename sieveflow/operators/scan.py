"""The match table: every rule's matches in every text, with offsets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import one_row_each
from ..functions.offsets import char_index, inclusive_end
from ..functions.spans import ends_in_window, first_end, spans, windows
from ..plans.compiled import CompiledRules
from .hits import HITS, RAW, RULE, TEXT, as_list, hit_pairs, sees_bytes, with_hits

MATCHES = "matches"
END_BLOCK = 256


def _position(rule: Column, span: Column, unit: str, byte_scan: bool, has_raw: bool) -> dict[str, Column]:
    """Public fields of one span.

    Text offsets are inclusive at both ends; byte scans keep an exclusive end. Without
    SOM_LEFTMOST a rule reports neither start nor text. Java rules always do.
    """
    som = rule["som"] | rule["java"]
    start, end, matched = span["s"], span["e"], span["m"]
    empty = end == start
    if not byte_scan:
        end = inclusive_end(end)
        if has_raw:
            # byte offsets of a rule that sees bytes, as characters of the text
            raw, seen = F.col(RAW), rule["bytes"]
            cp = char_index(raw, start, "codepoint")
            cp_end = char_index(raw, end, "codepoint")
            matched = F.when(seen, F.when(empty, F.lit("")).otherwise(
                F.substring(F.col(TEXT), (cp + 1).cast("int"), (cp_end - cp + 1).cast("int")))).otherwise(matched)
            start = F.when(seen, char_index(raw, start, unit)).otherwise(start)
            end = F.when(seen, char_index(raw, end, unit)).otherwise(end)
    zero = F.lit(0).cast("bigint")
    return {
        "start": F.when(som, start).otherwise(zero),
        "end": end,
        "matched": F.when(som, matched).otherwise(F.lit("")),
        # without a tracked start only the empty text is known to give an empty match
        "is_empty": F.when(som, empty).when(span["e"] == 0, F.lit(True)),
    }


def spans_of(rule: Column, df: DataFrame, compiled: CompiledRules, unit: str, semantics, byte_scan: bool) -> Column:
    shape = compiled.shape
    in_text = spans(F.col(TEXT), rule, "byte" if byte_scan else unit, semantics, shape)
    if RAW not in df.columns:
        return in_text
    return F.when(sees_bytes(rule, byte_scan), spans(F.col(RAW), rule, "codepoint", semantics, shape)).otherwise(in_text)


def _match_struct(rule: Column, span: Column, df: DataFrame, unit: str, byte_scan: bool) -> Column:
    fields = _position(rule, span, unit, byte_scan, RAW in df.columns)
    return F.struct(
        rule["ruleset"].alias("ruleset"), rule["rule_id"].alias("rule_id"),
        *[c.alias(n) for n, c in fields.items()])


def combination_condition(pattern: str, ruleset: str | None, ids: str = "_ids") -> str:
    """A combination such as ``0 & (1 | !2)`` as SQL over the array `ids`."""
    prefix = "" if ruleset is None else ruleset.replace("\\", "\\\\").replace("'", "\\'") + "#"
    sql = re.sub(r"\d+", lambda m: f"array_contains({ids}, '{prefix}{int(m.group())}')", pattern)
    return sql.replace("!", " NOT ").replace("&", " AND ").replace("|", " OR ")


def rule_ids(hits: Column) -> Column:
    return F.transform(hits, lambda r: F.concat_ws("#", r["ruleset"], r["rule_id"].cast("string")))


def combination_matches(compiled: CompiledRules) -> Column:
    """array<match> of the combinations that hold for the hit rules in `_ids`.

    A combination is a fact about the whole text: one match, no start, no end.
    """
    fired = [
        F.when(F.expr(combination_condition(c.pattern, c.ruleset)), F.struct(
            F.lit(c.ruleset).cast("string").alias("ruleset"), F.lit(c.rule_id).alias("rule_id"),
            F.lit(0).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"),
            F.lit("").alias("matched"), F.lit(None).cast("boolean").alias("is_empty")))
        for c in compiled.combinations if not c.quiet]
    return F.array_compact(F.array(*fired))


def matches_per_text(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=(),
                     offset_unit: str = "utf16", semantics: str | None = None,
                     byte_scan: bool = False) -> DataFrame:
    """One row per text with the array `matches`: the nested form of :func:`scan`.

    Everything happens inside the row, so nothing is shuffled and a text's matches are
    together for the operators that order, limit or combine them.
    """
    keep = [*as_list(key), *keep]
    views = found = with_hits(docs, compiled, text, keep, byte_scan)

    def of_rule(rule: Column) -> Column:
        return F.transform(
            spans_of(rule, views, compiled, offset_unit, semantics, byte_scan),
            lambda s: _match_struct(rule, s, views, offset_unit, byte_scan))

    reported = F.filter(F.col(HITS), lambda r: ~r["quiet"]) if compiled.has("quiet") else F.col(HITS)
    matches = F.flatten(F.transform(reported, of_rule))
    if any(not c.quiet for c in compiled.combinations):
        found = found.withColumn("_ids", rule_ids(F.col(HITS)))
        matches = F.concat(matches, combination_matches(compiled))
    return found.select(*keep, matches.alias(MATCHES))


def match_rows(df: DataFrame, keep, matches: Column) -> DataFrame:
    """`keep` and the fields of each match."""
    return one_row_each(df, keep, matches, "_match").select(*keep, "_match.*")


def scan(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=(),
         offset_unit: str = "utf16", semantics: str | None = None, byte_scan: bool = False,
         with_ruleset: bool = False, with_is_empty: bool = False, spread: bool = False) -> DataFrame:
    """One row (key, rule_id, start, end, matched) per match.

    An empty match at 0 and a match of one character at 0 have the same inclusive offsets;
    `with_is_empty` adds the column that tells them apart.

    `semantics` is 'all_ends' (every offset where a match ends, the default for direct
    rules) or 'find' (leftmost and non-overlapping, the default for Java rules). `spread`
    hands the search for ends in long runs to many tasks, for texts of many MB.
    """
    keep = [*as_list(key), *keep]
    columns = [*keep, *(["ruleset"] if with_ruleset else []), "rule_id", "start", "end", "matched",
               *(["is_empty"] if with_is_empty else [])]
    if not spread:
        rows = matches_per_text(docs, compiled, key, text, keep[len(as_list(key)):], offset_unit, semantics, byte_scan)
        return match_rows(rows, keep, F.col(MATCHES)).select(*columns)
    if compiled.combinations:
        raise ValueError("combinations are facts about whole texts, which are not spread")
    pairs = hit_pairs(docs, compiled, as_list(key), text, keep, byte_scan).where(f"NOT {RULE}.quiet")
    rule = F.col(RULE)

    def published(df: DataFrame, found: Column) -> DataFrame:
        return match_rows(df, keep, F.transform(
            found, lambda s: _match_struct(rule, s, pairs, offset_unit, byte_scan))).select(*columns)

    spans_here = spans_of(rule, pairs, compiled, offset_unit, semantics, byte_scan)
    if not spread or semantics == "find":
        return published(pairs, spans_here)
    scattered = rule["kind"].isin("runs", "whole") & ~rule["single"] & ~rule["java"]
    return published(pairs.where(~scattered), spans_here).unionByName(
        published(*_scattered_ends(pairs.where(scattered), offset_unit, byte_scan)))


def _scattered_ends(pairs: DataFrame, unit: str, byte_scan: bool) -> tuple[DataFrame, Column]:
    """Windows as rows, cut into blocks of ends and spread evenly; and the spans of a block."""
    rule, w, first = F.col(RULE), F.col("_window"), F.col("_first")

    def by_view(build) -> Column:
        in_text = build(F.col(TEXT), "byte" if byte_scan else unit)
        if RAW not in pairs.columns:
            return in_text
        return F.when(sees_bytes(rule, byte_scan), build(F.col(RAW), "codepoint")).otherwise(in_text)

    blocks = (
        one_row_each(pairs, ["*"], by_view(lambda view, u: windows(view, rule, u)), "_window")
        .select("*", F.explode(F.sequence(first_end(rule), w["n"], F.lit(END_BLOCK))).alias("_first"))
        .hint("rebalance"))
    last = F.least(first + (END_BLOCK - 1), w["n"])
    return blocks, by_view(lambda view, u: ends_in_window(w, rule, u, first, last))


def with_traits(compiled: CompiledRules, combinations=None, **traits: bool) -> CompiledRules:
    """The same rules with some Boolean traits set for all of them."""
    rows = [{**r, **traits} for r in compiled.rows] if compiled.fits else None
    table = compiled.table.withColumns({n: F.lit(v) for n, v in traits.items()})
    return CompiledRules(table, compiled.n_rules, rows, compiled.combinations if combinations is None else combinations)


def single_matches(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", **options) -> DataFrame:
    """At most one match per rule and text, the one of earliest end, whatever the flags."""
    return scan(docs, with_traits(compiled, single=True), key, text, **options)
