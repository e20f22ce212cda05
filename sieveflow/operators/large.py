"""The rules that hit a text, for a ruleset too large to travel with the plan.

Rules and texts meet on n-grams: each rule is filed under one n-gram per required literal, each
different text under those of its n-grams that some rule has. They are found in the row: the trie of the n-grams, or of as long beginnings
of them as `MAX_BEGINNINGS` allows, turns most places of a text away before anything is cut out. Both sides are shuffled on the
n-gram and carry ids only; adaptive execution splits a frequent one. Candidates are confirmed against the text, and each text gets the
array of its rules, so every operator goes on from here as it does for a small ruleset.

Texts are told apart by their content, not by the caller's key: what hits a text depends on nothing else.
Keys may be NULL or repeated, and copies of a text are confirmed once.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import one_row_each
from ..functions.offsets import latin1_view
from ..plans.compiled import MAX_RULE_BYTES, MAX_RULES, RULE_FIELDS, CompiledRules, places_of
from .hits import HITS, RAW, RULE, TEXT, hit_rules, is_hit, view_for, with_views

GRAM_LENGTHS = (6, 3, 2)
FILTER_BITS = 1 << 20
MAX_BEGINNINGS = 1 << 11
TID = "_tid"


def _gram_length(literal: Column) -> Column:
    n = F.length(literal)
    longest, *shorter = GRAM_LENGTHS
    return reduce(lambda c, k: c.when(n >= k, F.lit(k)), shorter, F.when(n >= longest, F.lit(longest)))


def rule_grams(table: DataFrame) -> DataFrame:
    literal = F.col("literal")
    return (table.where("literals IS NOT NULL AND NOT combination")
            .select(F.col("ruleset").alias("_set"), F.col("rule_id").alias("_id"), F.explode("literals").alias("literal"))
            .select("_set", "_id", F.substring(literal, F.lit(1), _gram_length(literal)).alias("gram")).distinct())


def _bit(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FILTER_BITS))


def _one_at(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))


def gram_filter(filed: DataFrame):
    """A test whether some rule may be filed under a gram: a bit set of fixed size."""
    words = filed.select(_bit(F.col("gram")).alias("b")).groupBy(F.floor(F.col("b") / 64).cast("int").alias("w")).agg(
        F.bit_or(_one_at(F.col("b"))).alias("bits")).collect()
    bits = [0] * (FILTER_BITS // 64)
    for r in words:
        bits[r.w] = r.bits
    table = F.from_json(F.lit(json.dumps(bits)), "array<bigint>")
    return lambda gram: F.get(table, F.floor(_bit(gram) / 64).cast("int")).bitwiseAND(_one_at(_bit(gram))) != 0


def gram_places(filed: DataFrame) -> dict[int, str]:
    """For each length of grams, a zero-width regex for the places of a text where one of them can begin."""
    longest = GRAM_LENGTHS[0]
    counts = filed.groupBy(F.length("gram").alias("k")).agg(*[
        F.count_distinct(F.substring("gram", 1, d)).alias(f"n{d}") for d in range(1, longest + 1)]).collect()
    places = {}
    for r in counts:
        # as many characters as leave few enough beginnings; a length with none to tell apart by is looked for everywhere
        d = max((d for d in range(1, r.k + 1) if r[f"n{d}"] <= MAX_BEGINNINGS), default=0)
        begin = filed.where(F.length("gram") == r.k).select(F.substring("gram", 1, d).alias("b")).distinct()
        places[r.k] = places_of([x.b for x in begin.collect()]) if d else ""
    return places


def text_grams(texts: DataFrame, places: dict[int, str], known) -> DataFrame:
    lower = F.lower(F.col(TEXT))
    grams = [F.regexp_extract_all(lower, F.lit(f"(?s){at}(?=(.{{{k}}}))"), F.lit(1)) for k, at in sorted(places.items())]
    return one_row_each(texts, [TID], F.filter(F.array_distinct(F.concat(*grams)), known), "gram")


def _by_gram(texts: DataFrame, compiled: CompiledRules) -> DataFrame:
    """(_tid, rule) of the candidates: a text has a gram of one of the rule's literals."""
    filed = rule_grams(compiled.table)
    places = gram_places(filed) or {GRAM_LENGTHS[0]: ""}
    pairs = text_grams(texts, places, gram_filter(filed)).join(filed, "gram").select(TID, "_set", "_id").distinct()
    rules = compiled.table.where("NOT combination").select(F.struct(*RULE_FIELDS).alias(RULE))
    return pairs.join(rules, F.col("_set").eqNullSafe(F.col(f"{RULE}.ruleset")) & (F.col("_id") == F.col(f"{RULE}.rule_id"))).select(TID, RULE)


def with_large_hits(docs: DataFrame, compiled: CompiledRules, text: str, keep, byte_scan: bool = False, confirm: bool = True) -> DataFrame:
    """`keep`, the views of the text, and the array of the rules that hit it (or may, without `confirm`)."""
    if docs.isStreaming:
        raise ValueError("beyond the size bound texts and rules are joined, which on a stream would need state without limit; "
                         "streams.deliver_results runs the operator on each micro-batch instead, with rulesets of every size")
    views = with_views(docs, None, text, keep, byte_scan).withColumn(TID, F.sha2(F.coalesce(F.col(TEXT), F.lit("")), 256))
    searched = views.where(F.col(TEXT).isNotNull())
    # what follows from the text is derived again rather than moved
    texts = searched.select(TID, TEXT, *([RAW] if byte_scan else [])).dropDuplicates([TID])
    texts = texts if byte_scan else texts.withColumn(RAW, latin1_view(F.col(TEXT)))
    found = _by_gram(searched.select(TID, TEXT), compiled).join(texts, TID)
    rule = F.col(RULE)
    lower = F.lower(F.col(TEXT))
    literal = F.exists(rule["literals"], lambda w: F.contains(lower, w)) & F.forall(
        F.coalesce(rule["also"], F.array().cast("array<string>")), lambda w: F.contains(lower, w))
    found = found.where(is_hit(view_for(rule, texts, byte_scan), rule) if confirm else literal)
    parts = [found.select(TID, RULE)]
    for chunk in unfiltered_chunks(compiled):
        rules = hit_rules(texts, chunk, byte_scan) if confirm else chunk.literal(chunk.held())
        parts.append(one_row_each(texts, [TID], rules, RULE))
    per_text = reduce(lambda a, b: a.unionByName(b), parts).groupBy(F.col(TID).alias("_of")).agg(F.collect_list(RULE).alias(HITS))
    joined = views.join(per_text, (F.col(TID) == F.col("_of")) & F.col(TEXT).isNotNull(), "left")
    empty = F.from_json(F.lit("[]"), joined.schema[HITS].dataType)
    return joined.withColumn(HITS, F.when(F.col(TEXT).isNotNull(), F.coalesce(F.col(HITS), empty))).drop("_of", TID)


def unfiltered_chunks(compiled: CompiledRules) -> list[CompiledRules]:
    """Rules without a required literal, which no join can find: tried on every text, in chunks of bounded size."""
    always = compiled.table.where("literals IS NULL AND NOT combination")
    n, size = always.agg(F.count("*"), F.sum(2 * F.octet_length("rx") + F.coalesce(F.octet_length("run_rx"), F.lit(0)))).first()
    k = max(-(-n // MAX_RULES), -(-(size or 0) // MAX_RULE_BYTES))
    bucket = F.pmod(F.xxhash64("ruleset", "rule_id"), F.lit(k))
    return [
        CompiledRules(compiled.table, n, [r.asDict() for r in always.where(bucket == i).collect()])
        for i in range(k)
    ]
