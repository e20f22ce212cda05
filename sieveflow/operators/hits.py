"""Which rules hit which texts (no positions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let, one_row_each
from ..functions.offsets import latin1_view
from ..plans.compiled import CompiledRules, any_alternation, foldable

TEXT, RAW, HITS, RULE = "_text", "_raw", "_hits", "_rule"


def as_list(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def with_views(docs: DataFrame, compiled: CompiledRules | None, text: str, keep, byte_scan: bool = False) -> DataFrame:
    """`keep` columns plus the text and, where a rule needs it, its bytes as characters."""
    raw_needed = byte_scan or compiled is None or compiled.uses_bytes
    if byte_scan:
        views = [F.col(text).cast("string").alias(TEXT), F.decode(F.col(text), "ISO-8859-1").alias(RAW)]
    else:
        views = [F.col(text).alias(TEXT)] + ([latin1_view(F.col(text)).alias(RAW)] if raw_needed else [])
    return docs.select(*keep, *views)


def sees_bytes(rule: Column, byte_scan: bool) -> Column:
    return ~rule["utf8"] if byte_scan else rule["bytes"]


def view_for(rule: Column, df: DataFrame, byte_scan: bool = False) -> Column:
    if RAW not in df.columns:
        return F.col(TEXT)
    return F.when(sees_bytes(rule, byte_scan), F.col(RAW)).otherwise(F.col(TEXT))


def is_hit(view: Column, rule: Column) -> Column:
    """Does the rule match? A chain of repeats is looked for once in each run, where its regex would begin at every place of it."""
    chains = F.regexp_extract_all(view, rule["test"], F.lit(1))
    return F.when(rule["test"].isNull(), F.rlike(view, rule["rx"])).otherwise(F.exists(chains, lambda c: c != ""))


def candidate_rules(compiled: CompiledRules) -> Column:
    return let(F.lower(F.col(TEXT)), compiled.candidates)


def hit_rules(df: DataFrame, compiled: CompiledRules, byte_scan: bool = False) -> Column:
    """array<rule>: the candidates that really match."""
    return F.filter(candidate_rules(compiled), lambda r: is_hit(view_for(r, df, byte_scan), r))


def hit_pairs(docs: DataFrame, compiled: CompiledRules, keys: list[str], text: str, keep,
              byte_scan: bool = False) -> DataFrame:
    """`keep`, the text and the rule: one row per text and rule that matches it."""
    if not compiled.fits:
        found = with_hits(docs, compiled, text, keep, byte_scan)
        return one_row_each(found, [c for c in found.columns if c != HITS], F.col(HITS), RULE)
    views = with_views(docs, compiled, text, keep, byte_scan)
    return one_row_each(views, ["*"], hit_rules(views, compiled, byte_scan), RULE)


def with_hits(docs: DataFrame, compiled: CompiledRules, text: str, keep, byte_scan: bool = False) -> DataFrame:
    """`keep`, the views of the text and the array of the rules that match it, whatever the ruleset's size."""
    if not compiled.fits:
        from .large import with_large_hits
        return with_large_hits(docs, compiled, text, keep, byte_scan)
    views = with_views(docs, compiled, text, keep, byte_scan)
    return views.withColumn(HITS, hit_rules(views, compiled, byte_scan))


def hits(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", keep=(),
         byte_scan: bool = False, with_ruleset: bool = False) -> DataFrame:
    """One row (key, rule_id) per rule that matches a text, quiet rules and combinations aside."""
    keep = [*as_list(key), *keep]
    chosen = [*(["ruleset"] if with_ruleset else []), "rule_id"]
    if compiled.fits:
        reported = compiled.only(lambda r: not r["quiet"])
        views = with_views(docs, reported, text, keep, byte_scan)
        pairs = one_row_each(views, keep, hit_rules(views, reported, byte_scan), RULE)
    else:
        pairs = hit_pairs(docs, compiled, as_list(key), text, keep, byte_scan).where(f"NOT {RULE}.quiet")
    return pairs.select(*keep, *[F.col(f"{RULE}.{c}").alias(c) for c in chosen])


def has_match_column(df: DataFrame, compiled: CompiledRules, byte_scan: bool = False) -> Column:
    """Does any rule report a match? Stops at the first one; quiet rules do not count.

    Rules without required literals have to be tried on every text, so those that can be
    are folded into one alternation.
    """
    filtered = compiled.only(lambda r: r["literals"] is not None and not r["quiet"])
    always = [r for r in compiled.rows if r["literals"] is None and not r["quiet"]]

    def reads_bytes(r) -> bool:
        return not r["utf8"] if byte_scan else r["bytes"]

    conditions = []
    for of_bytes in (False, True):
        folded = [r for r in always if foldable(r) and r["test"] is None and reads_bytes(r) == of_bytes]
        if folded:
            conditions.append(any_alternation(folded, F.col(RAW if of_bytes else TEXT)))
    single = compiled.only(lambda r: r["literals"] is None and not r["quiet"] and not (foldable(r) and r["test"] is None))
    for part in (filtered, single):
        if part.rows:
            conditions.append(F.exists(
                candidate_rules(part), lambda r: is_hit(view_for(r, df, byte_scan), r)))
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def with_has_match(docs: DataFrame, compiled: CompiledRules, text: str = "text",
                   name: str = "has_match", byte_scan: bool = False) -> DataFrame:
    """`docs` with a Boolean column."""
    from .scan import combination_matches, rule_ids
    keep = [F.col(c) for c in docs.columns]
    if compiled.fits:
        views = with_views(docs, compiled, text, keep, byte_scan)
        found, rules = has_match_column(views, compiled, byte_scan), hit_rules(views, compiled, byte_scan)
    else:
        views = with_hits(docs, compiled, text, keep, byte_scan)
        found, rules = F.exists(HITS, lambda r: ~r["quiet"]), F.col(HITS)
    if any(not c.quiet for c in compiled.combinations):
        views = views.withColumn("_ids", rule_ids(rules))
        found = found | (F.size(combination_matches(compiled)) > 0)
    return views.withColumn(name, F.coalesce(found, F.lit(False))).drop(TEXT, RAW, HITS, "_ids")


def any_match(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", byte_scan: bool = False) -> DataFrame:
    """The rows of `docs` with at least one match."""
    return _filtered(docs, compiled, key, text, byte_scan, True)


def no_match(docs: DataFrame, compiled: CompiledRules, key, text: str = "text", byte_scan: bool = False) -> DataFrame:
    """The rows of `docs` without a match."""
    return _filtered(docs, compiled, key, text, byte_scan, False)


def _filtered(docs, compiled, key, text, byte_scan, wanted) -> DataFrame:
    flagged = with_has_match(docs, compiled, text, "_has_match", byte_scan)
    kept = F.when(F.col("_has_match") == F.lit(wanted), F.array(F.lit(True)))
    return one_row_each(flagged, docs.columns, kept, "_kept").drop("_kept")


def lookup_rules(matches: DataFrame, compiled: CompiledRules, columns=("pattern", "flags")) -> DataFrame:
    """Rule attributes for each match; NULL for an id the ruleset does not have.

    Where several rulesets have an id, only matches with their ruleset (`with_ruleset=True`) say which rule is meant.
    """
    if "ruleset" not in matches.columns:
        shared = compiled.table.groupBy("rule_id").agg(F.count("*").alias("n")).where("n > 1").limit(10).collect()
        if shared:
            raise ValueError(f"several rulesets have rules {sorted(r.rule_id for r in shared)}: look up matches that carry their ruleset")
    on = ["ruleset", "rule_id"] if "ruleset" in matches.columns else ["rule_id"]
    rules = compiled.table.select(*on, *columns)
    rules = F.broadcast(rules) if compiled.fits else rules
    if len(on) == 1:
        return matches.join(rules, on, "left")
    right = rules.withColumnsRenamed({c: f"_{c}" for c in on})
    return matches.join(
        right, F.col("ruleset").eqNullSafe(F.col("_ruleset")) & (F.col("rule_id") == F.col("_rule_id")), "left",
    ).drop("_ruleset", "_rule_id")
