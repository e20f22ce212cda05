"""Compiling a rules table into Columns that name the candidate rules of a text.

One pass of one regex over the lower-case text finds which rules are worth trying: the
regex is the trie of a short anchor per required literal. Its cost does not grow with the
number of rules, there is no join and no shuffle, and what travels to the tasks is the
(size-checked) ruleset itself. A larger ruleset takes the join in `operators.large`.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
import sys
import zlib
from dataclasses import dataclass, field
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import flags as flag_functions, offsets, spans, syntax
from ..functions.binding import let
from ..functions.flags import has_flag, quote_literal, with_options
from ..functions.spans import Shape
from ..functions.syntax import (
    capture_groups, chain_test, fixed_width, java_source, java_tokens, last_atom, latin1_tokens, looks_around, marked_groups, merged_repeats,
    needs_byte_view, never_overlaps, plain_edge, required_literals, run_class, run_with_match, steps, tokens, widest,
)
from ..operators import validate
from ..operators.validate import RuleError, check_ruleset, nullable_rule, rule_error
from ..schemas import DIRECT, RULES
from ..sources.rules import load_rules, save_rules, with_positional_ids

MAX_RULES = 50_000
MAX_RULE_BYTES = 16 << 20
ANCHOR_LENGTH = 12
# RLIKE writes a constant pattern into generated code, where a string has at most 64 KiB
MAX_ALTERNATION = 8_000

RULE_FIELDS = {
    "rule_id": "int", "ruleset": "string", "rx": "string", "literals": "array<string>", "also": "array<string>", "bytes": "boolean",
    "utf8": "boolean", "kind": "string", "run_rx": "string", "last_rx": "string", "steps": "array<struct<rx:string,lo:int>>", "test": "string", "nullable": "boolean", "som": "boolean",
    "single": "boolean", "quiet": "boolean", "java": "boolean", "groups": "int",
}
RULE_TYPE = "struct<" + ",".join(f"{n}:{t}" for n, t in RULE_FIELDS.items()) + ">"


@lru_cache(maxsize=1)
def _derivation(application: str) -> list[dict[str, Column]]:
    """The derived columns, step by step. Building them costs more than running them."""
    pattern, flags, dialect = F.col("pattern"), F.col("flags"), F.col("dialect")
    toks, jtoks, body = F.col("toks"), F.col("jtoks"), F.col("body")
    literal = has_flag(flags, "LITERAL")
    ok = F.col("error").isNull() & ~has_flag(flags, "COMBINATION")
    nullable = F.when(ok, nullable_rule(body, flags, dialect))
    stepwise = steps(jtoks, flags, dialect)
    run = run_class(jtoks, flags)
    return [
        {"error": rule_error(pattern, flags, dialect), "toks": tokens(pattern)},
        {"bytes": needs_byte_view(toks, pattern, flags, dialect), "jtoks": merged_repeats(java_tokens(toks, dialect))},
        {"jtoks": F.when(F.col("bytes"), latin1_tokens(jtoks)).otherwise(jtoks)},
        {"body": F.when(literal, quote_literal(pattern)).otherwise(java_source(jtoks, dialect))},
        {
            "rx": with_options(body, flags, dialect, grouped=F.array_contains(toks, "|")),
            "run_rx": let(run, lambda r: with_options(run_with_match(r, body), flags, dialect)),
            "last_rx": F.when(~literal, with_options(last_atom(jtoks, dialect), flags, dialect)),
            "literals": required_literals(toks, pattern, flags, dialect),
            "also": required_literals(toks, pattern, flags, dialect, every=True),
            "kind": F.when(stepwise.isNotNull(), F.lit("steps")).when(nullable, F.lit("whole"))
                     .when(fixed_width(toks) & ~literal & never_overlaps(jtoks, flags), F.lit("apart"))
                     .when(fixed_width(toks) | literal, F.lit("fixed")).otherwise(F.lit("runs")),
            "steps": stepwise,
            "test": chain_test(jtoks, flags, dialect),
            "widest": widest(jtoks, pattern, flags),
            "nullable": F.coalesce(nullable, F.lit(False)),
            "groups": F.when(literal, F.lit(0)).otherwise(capture_groups(toks)),
            "utf8": has_flag(flags, "UTF8"),
            "som": has_flag(flags, "SOM_LEFTMOST"),
            "single": has_flag(flags, "SINGLEMATCH"),
            "quiet": has_flag(flags, "QUIET"),
            "combination": has_flag(flags, "COMBINATION"),
            "java": dialect != DIRECT,
        },
    ]


def group_marks(rules: DataFrame) -> DataFrame:
    """(ruleset, rule_id, marked, marks, wide, unsure) of the rules with capturing groups: see `marked_groups`."""
    pattern, flags, dialect = F.col("pattern"), F.col("flags"), F.col("dialect")
    toks = merged_repeats(java_tokens(tokens(pattern), dialect))
    jtoks = F.when(F.col("bytes"), latin1_tokens(toks)).otherwise(toks)
    marked = rules.where("groups > 0").select("ruleset", "rule_id", "flags", "dialect", jtoks.alias("_toks")).select(
        "ruleset", "rule_id", "flags", "dialect", looks_around(F.col("_toks")).alias("wide"),
        marked_groups(F.when(dialect == DIRECT, F.transform("_toks", plain_edge)).otherwise(F.col("_toks"))).alias("_m"))
    return marked.select("ruleset", "rule_id", with_options(F.col("_m.rx"), flags, dialect).alias("marked"), F.col("_m.groups").alias("marks"), "wide",
                         F.col("_m.unsure").alias("unsure"))


def derive(rules: DataFrame) -> DataFrame:
    """The rules table with everything a scan needs to know about each rule."""
    steps = _derivation(rules.sparkSession.sparkContext.applicationId)
    table = rules
    for step in steps:
        table = table.withColumns(step)
    return table.drop("toks", "jtoks", "body", "pos")


def _prefix_free(words) -> list[str]:
    """The words of which no other word is a prefix: at one place at most one can match."""
    kept: list[str] = []
    for w in sorted(set(words)):
        if not (kept and w.startswith(kept[-1])):
            kept.append(w)
    return kept


def _escape(c: str, special: str = r"\.[]{}()*+?^$|-&#~") -> str:
    return "\\" + c if c in special else c


def _trie(words: list[str]) -> str:
    """A regex for `words` (sorted, prefix-free) that shares their common beginnings."""
    branches: dict[str, list[str]] = {}
    for w in words:
        branches.setdefault(w[0], []).append(w[1:])
    parts = [_escape(c) + ("" if rest == [""] else _trie(rest)) for c, rest in branches.items()]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def _guard(anchors: list[str]) -> str:
    """Classes for the first characters, which turn most places away before a trie is walked."""
    guard = ""
    for i in range(min(len(a) for a in anchors)):
        guard += "[" + "".join(_escape(c) for c in sorted({a[i] for a in anchors})) + "]"
    return f"(?={guard})" if len(guard) < 4000 else ""


def anchor_regex(anchors: list[str]) -> str:
    """Zero-width regex whose group 1 is the anchor at each place of a text."""
    return f"{_guard(anchors)}(?=({_trie(anchors)}))"


def places_of(words: list[str]) -> str:
    """Zero-width regex for the places of a text where one of the words, which are not empty, stands."""
    anchors = _prefix_free(words)
    return f"{_guard(anchors)}(?={_trie(anchors)})"


@dataclass
class CompiledRules:
    """A checked ruleset. `table` has the derived columns; `rows` is the same, held by the
    driver because it is within the size bound (else None)."""

    table: DataFrame
    n_rules: int
    rows: list | None
    combinations: list = field(default_factory=list)
    kept: DataFrame | None = None

    def release(self) -> None:
        """Give up what is kept of a ruleset beyond the size bound; its scans would derive it anew."""
        if self.kept is not None:
            self.kept.unpersist()

    @property
    def fits(self) -> bool:
        return self.rows is not None

    def held(self) -> list:
        """The rules, for operators that need them at hand."""
        if self.rows is None:
            raise ValueError("the ruleset is beyond the size bound; this operator needs one within it")
        return self.rows

    def has(self, trait: str) -> bool:
        """Does some rule have a Boolean trait? Unknown of a ruleset that is not held, so assumed."""
        return self.rows is None or any(r[trait] for r in self.rows)

    @property
    def uses_bytes(self) -> bool:
        return self.has("bytes")

    @property
    def shape(self) -> Shape:
        if self.rows is None or not self.rows:
            return Shape()
        return Shape(
            apart=any(r["kind"] == "apart" for r in self.rows),
            fixed=any(r["kind"] == "fixed" for r in self.rows),
            steps=any(r["kind"] == "steps" for r in self.rows),
            variable=any(r["kind"] in ("runs", "whole") for r in self.rows),
            java=any(r["java"] for r in self.rows),
            direct=any(not r["java"] for r in self.rows),
            single=any(r["single"] for r in self.rows))

    def only(self, keep) -> CompiledRules:
        """The same ruleset with the rows for which `keep(row)` holds."""
        return CompiledRules(self.table, self.n_rules, [r for r in self.held() if keep(r)], self.combinations)

    def literal(self, rows) -> Column:
        # what repeats the rule only travels where it is used
        only = {"run_rx": "runs", "steps": "steps", "test": "steps"}
        def value(r, name):
            if r["kind"] != only.get(name, r["kind"]) or r[name] is None:
                return None
            if name == "also":  # one literal is looked for anyway
                return [w for w in r[name] if [w] != r["literals"]] or None
            return [s.asDict() for s in r[name]] if name == "steps" else r[name]

        text = json.dumps([{n: value(r, n) for n in RULE_FIELDS} for r in rows])
        return F.from_json(F.lit(text), f"array<{RULE_TYPE}>")

    def candidates(self, lower_text: Column) -> Column:
        """array<rule>: every rule that can match a text with this lower-case form.

        A rule without required literals is always in. The result is whole: a rule is left
        out only if the text holds none of its literals.
        """
        always = [r for r in self.held() if r["literals"] is None]
        filtered = [r for r in self.held() if r["literals"] is not None]
        if not filtered:
            return self.literal(always)
        anchors = _prefix_free(w[:ANCHOR_LENGTH] for r in filtered for w in r["literals"])
        by_anchor: dict[str, set[int]] = {}
        kept = set(anchors)
        for i, r in enumerate(filtered):
            for w in r["literals"]:
                a = next(w[:n] for n in range(1, len(w) + 1) if w[:n] in kept)
                by_anchor.setdefault(a, set()).add(i + 1)
        n_buckets = 1 << max(len(anchors) // 4, 1).bit_length()
        buckets: list[list] = [[] for _ in range(n_buckets)]
        for a, ids in by_anchor.items():
            buckets[zlib.crc32(a.encode()) % n_buckets].append({"a": a, "r": sorted(ids)})
        index = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<a:string,r:array<int>>>>")
        rules = self.literal(filtered)

        def rule_numbers(anchor: Column) -> Column:
            bucket = F.element_at(index, (F.crc32(anchor) % n_buckets + 1).cast("int"))
            return F.flatten(F.transform(F.filter(bucket, lambda e: e["a"] == anchor), lambda e: e["r"]))

        found = F.array_distinct(F.regexp_extract_all(lower_text, F.lit(anchor_regex(anchors)), F.lit(1)))
        numbers = F.array_distinct(F.flatten(F.transform(found, rule_numbers)))
        tried = F.filter(
            F.transform(numbers, lambda i: F.element_at(rules, i)),
            lambda r: F.exists(r["literals"], lambda w: F.contains(lower_text, w))
            & F.forall(F.coalesce(r["also"], F.array().cast("array<string>")), lambda w: F.contains(lower_text, w)))
        return F.concat(tried, self.literal(always)) if always else tried


def compile_rules(rules: DataFrame, strict: bool = True, max_rules: int = MAX_RULES,
                  max_bytes: int = MAX_RULE_BYTES) -> CompiledRules:
    """Check a rules table and prepare it for scanning.

    `strict` raises on an unusable rule and names it; otherwise such rules are left out
    (``validate_rules`` lists them). A set beyond `max_rules`, or beyond `max_bytes` before or after
    compiling, does not travel with plans; its scans join instead and give the same rows.
    """
    summary = check_ruleset(rules)
    if summary.n_ids == 0:
        rules = with_positional_ids(rules)
    table, kept = derive(rules), None
    fits = summary.n_rules <= max_rules and summary.n_bytes <= max_bytes
    if fits:
        rows = table.collect()
        bad = [r for r in rows if r.error is not None]
    else:
        # read by every scan; kept so that the rules are not analysed again each time
        table = kept = table.persist()
        rows, bad = None, table.where("error IS NOT NULL").limit(100).collect() if strict else []
    if strict and bad:
        failed = [(r.rule_id, r.pattern, r.error) for r in bad]
        if fits:
            raise RuleError(failed)
        every = table.where("error IS NOT NULL").select("ruleset", "rule_id", "pattern", "error")
        raise RuleError(failed, every.count(), every)
    if fits:
        # the rows at hand are the table from now on, so a costly source of rules is read only once
        table = table.sparkSession.createDataFrame([r for r in rows if r.error is None], table.schema)
    return _assembled(table, rows, summary.n_rules, max_bytes, kept)


def _assembled(table: DataFrame, rows: list | None, n_rules: int, max_bytes: int, kept: DataFrame | None) -> CompiledRules:
    """The ruleset of a derived table, whose `rows` are at hand if it is within the bound."""
    fits = rows is not None
    if fits and sum(len(r.rx or "") + len(r.run_rx or "") + sum(map(len, r.literals or ())) for r in rows) > max_bytes:
        fits, kept = False, table.persist()
    table = table if fits else table.where("error IS NULL")
    if fits:
        combinations = [r for r in rows if r.error is None and r.combination]
        plain = [r.asDict() for r in rows if r.error is None and not r.combination]
        ids = {(r["ruleset"], r["rule_id"]) for r in plain}
    else:
        # combinations are evaluated as one expression each, so there cannot be many
        combinations, plain = table.where("combination").collect(), None
        named = sorted({int(n) for c in combinations for n in re.findall(r"\d+", c.pattern)})
        ids = {(r.ruleset, r.rule_id) for r in table.where("NOT combination").where(F.col("rule_id").isin(named))
               .select("ruleset", "rule_id").collect()} if named else set()
    for c in combinations:
        missing = sorted({int(n) for n in re.findall(r"\d+", c.pattern) if (c.ruleset, int(n)) not in ids})
        if missing:
            raise RuleError([(c.rule_id, c.pattern, f"refers to unknown rules {missing}")])
    return CompiledRules(table, n_rules, plain, combinations, kept)


SAMPLED_TEXTS = 200


def choose_factors(compiled: CompiledRules, docs: DataFrame, text: str = "text", n_texts: int = SAMPLED_TEXTS) -> CompiledRules:
    """The same ruleset, looking first for the literal of each rule that fewest texts hold.

    Judged by at most `n_texts` texts of `docs`. That changes which texts are tried, never which match: of a rule's
    literals each match contains all. A ruleset beyond the size bound is returned as it is.
    """
    if not compiled.fits:
        return compiled
    choices = sorted({w for r in compiled.rows if r["also"] and len(r["also"]) > 1 for w in r["also"]})
    if not choices:
        return compiled
    words = F.from_json(F.lit(json.dumps(choices)), "array<string>")
    held = docs.select(F.lower(F.col(text)).alias("t")).where("t IS NOT NULL").limit(n_texts).select(
        F.explode(F.filter(words, lambda w: F.contains(F.col("t"), w))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    n = {r.w: r.n for r in held.collect()}  # at most one row per literal of the ruleset
    rows = [{**r, "literals": [min(r["also"], key=lambda w: (n.get(w, 0), -len(w), w))]} if r["also"] and len(r["also"]) > 1 else r
            for r in compiled.rows]
    return CompiledRules(compiled.table, compiled.n_rules, rows, compiled.combinations)


def library_digest() -> str:
    """Changes with everything that a derived column depends on."""
    parts = (syntax, flag_functions, spans, offsets, validate, sys.modules[__name__])
    return hashlib.sha256("".join(inspect.getsource(m) for m in parts).encode()).hexdigest()


def rules_digest(rules: DataFrame) -> str:
    """The same for equal rules in any order; repeated rules count."""
    each = F.xxhash64(*(F.col(c) for c in RULES.fieldNames()))
    again = F.xxhash64(F.lit("again"), *(F.col(c) for c in RULES.fieldNames()))
    n, x, y = rules.agg(F.count("*"), F.coalesce(F.bit_xor(each), F.lit(0)), F.coalesce(
        F.sum((again % 1_000_003).cast("decimal(38,0)")), F.lit(0)).cast("string")).first()
    return f"{n} {x} {y}"


def save_compiled(rules: DataFrame, path: str, mode: str = "errorifexists", **options) -> CompiledRules:
    """Compile a rules table and save it with its derived columns: `rules`, `derived` and `digest` under `path`."""
    spark, path = rules.sparkSession, path.rstrip("/")
    save_rules(rules, f"{path}/rules", mode)
    rules = load_rules(spark, f"{path}/rules")
    compiled = compile_rules(rules, **options)
    # in few files: a reload is bound by their number
    compiled.table.coalesce(1 if compiled.fits else 8).write.mode(mode).parquet(f"{path}/derived")
    n_bytes = rules.agg(F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()[0]
    spark.createDataFrame([(library_digest(), rules_digest(rules), compiled.n_rules, n_bytes)],
                          "library string, rules string, n_rules long, n_bytes long").coalesce(1).write.mode(mode).parquet(f"{path}/digest")
    return compiled


def load_compiled(spark: SparkSession, path: str, strict: bool = True, max_rules: int = MAX_RULES,
                  max_bytes: int = MAX_RULE_BYTES) -> CompiledRules:
    """What :func:`save_compiled` saved. Rules are compiled anew only if they, or this library, have changed since."""
    path = path.rstrip("/")
    rules = load_rules(spark, f"{path}/rules")
    saved = spark.read.parquet(f"{path}/digest").first()
    if saved.library != library_digest() or saved.rules != rules_digest(rules):
        return compile_rules(rules, strict, max_rules, max_bytes)
    table = spark.read.parquet(f"{path}/derived")
    if saved.n_rules <= max_rules and saved.n_bytes <= max_bytes:
        return _assembled(table, table.collect(), saved.n_rules, max_bytes, None)
    kept = table.persist()
    return _assembled(kept, None, saved.n_rules, max_bytes, kept)


def alternations(rows) -> list[str]:
    """The rules folded into as few regexes as the size limit allows.

    Each rule is a group of its own, which also keeps its options to itself. A rule with a
    back-reference or a named group cannot be folded; callers leave those out.
    """
    chunks: list[str] = []
    for r in rows:
        part = f"(?:{r['rx']})"
        if chunks and len(chunks[-1]) + len(part) < MAX_ALTERNATION:
            chunks[-1] += "|" + part
        else:
            chunks.append(part)
    return chunks


def foldable(row) -> bool:
    return not re.search(r"\\[1-9kg]|\(\?P?<\w|\\Q", row["rx"])


def any_alternation(rows, view: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.rlike(view, F.lit(c)) for c in alternations(rows)], F.lit(False))
