"""Literal prefilter with exact confirmation, and capture groups.

The way to run Java regexes: candidates never miss a match, the confirm step is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let, one_row_each
from ..functions.offsets import char_index, convert_offset
from ..functions.spans import find_spans, free_mark
from ..plans.compiled import CompiledRules, group_marks
from .hits import HITS, RAW, RULE, TEXT, as_list, candidate_rules, hit_pairs, view_for, with_has_match, with_views
from .large import with_large_hits


def _chosen(with_ruleset: bool, prefix: str = "") -> list[Column]:
    """The columns that name a rule."""
    return [F.col(f"{prefix}{c}").alias(c) for c in (["ruleset"] if with_ruleset else []) + ["rule_id"]]


def candidates(docs, compiled: CompiledRules, key, text="text", with_ruleset: bool = False) -> DataFrame:
    """(key, rule_id, filterable): a superset of the hits.

    A rule that nothing can be told about (`filterable` false) is a candidate of every text.
    """
    keep = as_list(key)
    if compiled.fits:
        tried = one_row_each(with_views(docs, compiled, text, keep), keep, candidate_rules(compiled), RULE)
    else:
        tried = one_row_each(with_large_hits(docs, compiled, text, keep, confirm=False), keep, F.col(HITS), RULE)
    return tried.select(*keep, *_chosen(with_ruleset, f"{RULE}."), F.col(f"{RULE}.literals").isNotNull().alias("filterable"))


def confirmed(docs, compiled: CompiledRules, key, text="text", full_match: bool = False, with_ruleset: bool = False) -> DataFrame:
    r"""Candidates whose regex is found in the text or, with `full_match`, matches all of it."""
    keep = as_list(key)
    pairs = hit_pairs(docs, compiled, keep, text, keep)
    if full_match:
        whole = F.concat(F.lit(r"\A(?:"), F.col(f"{RULE}.rx"), F.lit(r")\z"))
        pairs = pairs.where(F.rlike(view_for(F.col(RULE), pairs), whole))
    return pairs.select(*keep, *_chosen(with_ruleset, f"{RULE}."))


def capture_groups(docs, compiled: CompiledRules, key, text="text", with_ruleset: bool = False) -> DataFrame:
    """(key, rule_id, match_no, group_no, value) for every group of every `find()` match.

    Group 0 is the match. A group that took no part gives the empty string.
    """
    keep = as_list(key)
    pairs = hit_pairs(docs, compiled, keep, text, keep)
    rule = F.col(RULE)
    # the text stays in its row: what is exploded are the groups
    groups = F.transform(F.sequence(F.lit(0), rule["groups"]), lambda g: F.struct(
        g.alias("group_no"), F.regexp_extract_all(view_for(rule, pairs), rule["rx"], g).alias("values")))
    found = one_row_each(pairs.select(*keep, rule["ruleset"].alias("ruleset"), rule["rule_id"].alias("rule_id"), rule["bytes"].alias("_bytes"), groups.alias("_g")),
                         [*keep, "ruleset", "rule_id", "_bytes"], F.col("_g"), "_group")
    # a rule that sees bytes finds them as characters of one byte each
    value = F.when(F.col("_bytes"), F.decode(F.encode("value", "ISO-8859-1"), "UTF-8")).otherwise(
        F.col("value")) if RAW in pairs.columns else F.col("value")
    return (found.select(*keep, "ruleset", "rule_id", "_bytes", "_group.group_no", F.posexplode_outer("_group.values").alias("match_no", "value"))
            .where("value IS NOT NULL").select(*keep, *_chosen(with_ruleset), "match_no", "group_no", value.alias("value")))


# characters beyond a match that ^ $ \b look at
CONTEXT_AFTER = 3


def group_spans(docs, compiled: CompiledRules, key, text="text", offset_unit: str = "utf16", with_ruleset: bool = False) -> DataFrame:
    """(key, rule_id, match_no, group_no, start, end, value) for every group of every `find()` match.

    `end` is exclusive. Group 0 is the match. A group that took no part has NULL for all three; one that matched the empty text
    has two equal offsets. Each match is searched once more, in itself and a few characters around it, with a regex that
    also captures what precedes each group; a group's place is the sum of such lengths. Rules with a group inside a
    repeated one or a lookaround, whose place that does not tell, are refused by name.
    """
    keep = as_list(key)
    marks = group_marks(compiled.table)
    unsure = marks.where("unsure").select("rule_id").limit(100).collect()
    if unsure:
        raise ValueError(f"groups inside repeated groups or lookarounds, or referred to by name, have no offsets: rules {sorted(r.rule_id for r in unsure)}")
    marks = marks.withColumnsRenamed({"ruleset": "_mset", "rule_id": "_mid"})
    marks = F.broadcast(marks) if compiled.fits else marks
    pairs = hit_pairs(docs, compiled, keep, text, keep)
    pairs = pairs.join(marks, F.col(f"{RULE}.ruleset").eqNullSafe(F.col("_mset")) & (F.col(f"{RULE}.rule_id") == F.col("_mid")), "left")
    rule, has_raw = F.col(RULE), RAW in pairs.columns
    view = view_for(rule, pairs)

    def of_match(m: Column, i: Column) -> Column:
        first = F.when(F.col("wide"), m["s"]).otherwise(F.least(m["s"], F.lit(1).cast("bigint")))
        after = F.when(F.col("wide"), F.length(view)).otherwise(F.lit(CONTEXT_AFTER))
        window = F.substring(view, (m["s"] - first + 1).cast("int"), (m["e"] - m["s"] + first).cast("int") + after)
        whole = F.struct(F.lit(0).alias("group_no"), m["s"].alias("s"), m["e"].alias("e"), m["m"].alias("value"))

        def of_groups(b: Column) -> Column:
            before = F.concat(F.lit(r"\A(?s:.{"), b["first"].cast("string"), F.lit("})(?>"), F.col("marked"), F.lit(")"))
            shown = F.array_join(F.flatten(F.transform(F.col("marks"), lambda g: F.when(g["opaque"], F.array(b["mark"], b["mark"], b["mark"])).otherwise(F.array(
                F.concat(F.lit("${zp"), g["id"].cast("string"), F.lit("}"), b["mark"]),
                F.concat(F.when(g["repeated"], F.concat(F.lit("${zr"), g["id"].cast("string"), F.lit("}"))).otherwise(F.lit("")), b["mark"]),
                F.concat(F.when(g["n"] > 0, F.concat(F.lit("${zc"), g["n"].cast("string"))).otherwise(F.concat(F.lit("${zg"), g["id"].cast("string"))),
                         F.lit("}"), b["mark"]))))), "")
            found = F.split(F.regexp_replace(b["w"], before, shown), b["mark"], -1)

            def groups(parts: Column) -> Column:
                def place(known: Column, g: Column) -> Column:
                    preceding, repeats, own = (F.length(F.get(parts, (g["id"] - 1) * 3 + k)) for k in range(3))
                    at = F.coalesce(F.get(known, g["parent"] - 1), m["s"]) + preceding
                    return F.concat(known, F.array(at + F.when(g["repeated"], repeats - own).otherwise(0)))

                def one(g: Column, at: Column) -> Column:
                    value = F.get(parts, (g["id"] - 1) * 3 + 2)
                    # a reference to a group that took no part fails
                    took_part = (value != "") | F.rlike(b["w"], F.concat(before, F.lit(r"\k<zc"), g["n"].cast("string"), F.lit(">")))
                    return F.struct(g["n"].alias("group_no"), F.when(took_part, at).alias("s"), F.when(took_part, at + F.length(value)).alias("e"),
                                    F.when(took_part, value).alias("value"))

                places = F.aggregate("marks", F.array().cast("array<bigint>"), place)
                return let(places, lambda at: F.transform(F.filter("marks", lambda g: g["n"] > 0), lambda g: one(g, F.get(at, g["id"] - 1))))

            return let(found, groups)

        groups = let(F.struct(window.alias("w"), first.alias("first"), free_mark(window).alias("mark")), of_groups)
        return F.struct(i.alias("match_no"), F.when(F.col("marks").isNull(), F.array(whole)).otherwise(F.concat(F.array(whole), groups)).alias("groups"))

    matches = F.transform(find_spans(view, rule["rx"], "codepoint"), of_match)
    rows = one_row_each(one_row_each(pairs, ["*"], matches, "_match"), ["*"], F.col("_match.groups"), "_group")
    s, e, value = F.col("_group.s"), F.col("_group.e"), F.col("_group.value")
    if has_raw:
        raw, seen = F.col(RAW), rule["bytes"]

        def placed(at: Column) -> Column:
            # behind the character of the byte before
            of_bytes = F.when(at == 0, at).otherwise(char_index(raw, at - 1, offset_unit) + 1)
            return F.when(seen, of_bytes).otherwise(convert_offset(F.col(TEXT), at, offset_unit))

        value = F.when(seen, F.decode(F.encode(value, "ISO-8859-1"), "UTF-8")).otherwise(value)
        s, e = placed(s), placed(e)
    elif offset_unit != "codepoint":
        s, e = (convert_offset(F.col(TEXT), x, offset_unit) for x in (s, e))
    return rows.select(*keep, *_chosen(with_ruleset, f"{RULE}."), F.col("_match.match_no").alias("match_no"), F.col("_group.group_no").alias("group_no"),
                       s.alias("start"), e.alias("end"), value.alias("value"))


def any_match_alternation(docs, compiled: CompiledRules, key, text="text") -> DataFrame:
    """Keys of the texts that some rule or combination matches.

    Rules with required literals are only tried where one is found; the others are folded into few regexes.
    """
    return with_has_match(docs, compiled, text, "_found").where("_found").select(*as_list(key))
