"""Order, limits and early stops within a text, and match counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from ..plans.compiled import CompiledRules
from .hits import RULE, as_list, hit_pairs, view_for
from .scan import MATCHES, match_rows, matches_per_text, spans_of


def _in_order(matches: Column) -> Column:
    """By (end, start, rule_id, ruleset); combinations, which have no end, come last."""
    keyed = F.transform(matches, lambda m: F.struct(
        m["end"].isNull().alias("whole_text"), m["end"].alias("end"), m["start"].alias("start"),
        m["rule_id"].alias("rule_id"), m["ruleset"].alias("ruleset"), m.alias("m")))
    return F.transform(F.array_sort(keyed), lambda k: k["m"])


def _rows(nested: DataFrame, matches: Column, keep, with_ruleset: bool) -> DataFrame:
    columns = [*keep, *(["ruleset"] if with_ruleset else []), "rule_id", "start", "end", "matched"]
    return match_rows(nested, keep, matches).select(*columns)


def ordered_matches(docs, compiled: CompiledRules, key, text="text", with_ruleset: bool = False, **options) -> DataFrame:
    """Matches with `seq`, their place in the text by (end, start, rule_id, ruleset)."""
    nested = matches_per_text(docs, compiled, key, text, **options)
    out = nested.select(*as_list(key), F.posexplode_outer(_in_order(F.col(MATCHES))).alias("seq", "m"))
    columns = [*as_list(key), "seq", *(["m.ruleset"] if with_ruleset else []), "m.rule_id", "m.start", "m.end", "m.matched"]
    return out.where("m IS NOT NULL").select(*columns)


def first_k(docs, compiled: CompiledRules, key, k: int, text="text", with_ruleset: bool = False, **options) -> DataFrame:
    """The first `k` matches of each text, all rules together, by (end, start, rule_id, ruleset)."""
    nested = matches_per_text(docs, compiled, key, text, **options)
    return _rows(nested, F.slice(_in_order(F.col(MATCHES)), 1, k), as_list(key), with_ruleset)


def take_until(docs, compiled: CompiledRules, key, stop, text="text", with_ruleset: bool = False, **options) -> DataFrame:
    """The matches of each text up to and including the first for which `stop(match)` holds.

    `stop` gets a struct column with ruleset, rule_id, start, end and matched.
    """
    def cut(ms: Column) -> Column:
        at = F.array_position(F.transform(ms, stop), F.lit(True))
        return F.when(at > 0, F.slice(ms, F.lit(1), at.cast("int"))).otherwise(ms)

    nested = matches_per_text(docs, compiled, key, text, **options)
    return _rows(nested, let(_in_order(F.col(MATCHES)), cut), as_list(key), with_ruleset)


def match_counts(docs, compiled: CompiledRules, by=(), text="text", with_ruleset: bool = False, semantics: str = "find") -> DataFrame:
    """Number of matches per rule (and `by` columns), by `find()`; positions are not computed.

    With `semantics` "own" each rule's matches count as a scan reports them (every end of a direct rule, one match with
    SINGLEMATCH). Quiet rules report nothing. Rules of equal id in different rulesets are counted apart.
    """
    if semantics not in ("find", "own"):
        raise ValueError(f"unknown semantics {semantics!r}, expected 'find' or 'own'")
    by = as_list(by)
    pairs = hit_pairs(docs, compiled, [], text, by).where(f"NOT {RULE}.quiet")
    rule = F.col(RULE)
    if semantics == "find":
        n = F.regexp_count(view_for(rule, pairs), rule["rx"])
    else:
        n = F.size(spans_of(rule, pairs, compiled, "codepoint", None, False))
    counts = (pairs.select(*by, *(F.col(f"{RULE}.{c}").alias(c) for c in ("ruleset", "rule_id")), n.alias("n"))
              .groupBy(*by, "ruleset", "rule_id").agg(F.sum("n").alias("n_matches"), F.count("*").alias("n_texts")))
    return counts if with_ruleset else counts.drop("ruleset")
