"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    any_match, any_match_alternation, byte_slice, candidates, capture_groups, choose_factors, combination_events, combinations, compile_rules,
    confirmed, first_k, group_spans, hits, load_compiled, load_rules, lookup_rules, match_counts, matches_per_text, no_match,
    for_each_match, ordered_matches, rule, rule_counts, rule_hits_per_text, rules_from_df, rules_from_regex, rules_table, ruleset_diff,
    ruleset_problems, same_rulesets,
    save_compiled, save_rules, scan, scan_files, single_matches, take_until, validate_rules, with_flag_bits, with_has_match,
    with_positional_ids, work_folder,
)
from .functions.offsets import byte_to_char, clean_utf8, convert_offset, is_clean_utf8
from .operators.rulesets import normalized
from .operators.validate import duplicate_ids
from .sources.inputs import spread_small_input
from .streaming.streams import (
    deliver_once, deliver_results, delivered, read_stream, run_available, session_combinations, single_alerts, stream_hits, windowed_counts,
)

SOM = "SOM_LEFTMOST"

# (rule_id, pattern, flags). The SQL side writes CASELESS, DOTALL and MULTILINE as inline options.
PERSONAL_DATA = [
    (0, r"[\w.]+@[\w.]+\.com", [SOM]),
    (1, r"(?:\d{1,3}\.){3}\d{1,3}", [SOM]),
    (2, r"licensed under|released under", [SOM, "CASELESS"]),
    (3, r'token = "[0-9a-f]{40}"', [SOM]),
    (4, r"\+1 \(\d{3}\) \d{3}-\d{4}", [SOM]),
    (5, r"\d{16}", [SOM]),
    (6, r"MIT License", [SOM]),
]
WORDS = [
    (10, r"\bthe\b", [SOM, "CASELESS"]),
    (11, r"[A-Z][a-z]+", [SOM]),
    (12, r"[!%*&$#]{3}", [SOM]),
    (13, r"que", [SOM, "UTF8"]),
]
NAMES = [
    (20, r"[a-z]+ b[a-z]+", [SOM]),
    (21, r"red|blue|large", [SOM]),
    (22, r"(?:l+)(?:t|d)?", [SOM]),
    (23, r"o[a-z]{1,3}", [SOM]),
    (24, r"ge", [SOM]),
]
RUNS = [
    (1, r"(?:\d{1,3}\.){3}\d{1,3}", [SOM]),
    (30, r"[%*]+", [SOM]),
    (31, r"tr[aeiou]+n?", [SOM]),
]
# rules whose ends lie anywhere behind a repeat
REPEATS = [
    (40, r"a.*x", [SOM, "UTF8"]),
    (41, r"^.*the.*and.*$", [SOM, "UTF8", "MULTILINE"]),
    (42, r"^.*the.*and.*$", [SOM, "UTF8", "DOTALL"]),
]
SWEPT_IDS = {2, 6, 10, 12, 13}
SWEPT_COMBINED = [(200, "2 & 6"), (201, "!10 | 13"), (202, "10 & !12")]
FLAG_CASES = [
    (0, r"^The ", []),
    (1, r"^the ", ["CASELESS"]),
    (2, r"^The ", ["MULTILINE"]),
    (3, r"^the ", ["CASELESS", "MULTILINE"]),
    (4, r"re\.$", []),
    (5, r"re\.$", ["MULTILINE"]),
    (6, r"\..Th", ["UTF8"]),
    (7, r"\..Th", ["UTF8", "DOTALL"]),
    (8, r"\..TH", ["UTF8", "DOTALL", "CASELESS"]),
]
# (rule_id, pattern, java.util.regex option bits)
JAVA_CASES = [
    (0, r"the (of|and)", 0),
    (1, r"the (of|and)", 2),
    (2, r"^the", 10),
    (3, r"re\..Th", 32),
    (4, r"+1 (", 16),
    (5, "lic  [e]nsed # a word\n under", 6),
]
GROUPS = [
    (0, r"([\w.]+)@([\w.]+)\.com", []),
    (1, r"\+1 \((\d{3})\) (\d{3})-(\d{4})", []),
    (2, r"(licensed|released) under", ["CASELESS"]),
]
# rules of bounded width, for files in blocks
BOUNDED = [
    (50, r"qu[ae]", [SOM]),
    (51, r"\d{16}", [SOM]),
    (52, r"(?:\d{1,3}\.){3}\d{1,3}", [SOM]),
    (53, r"licensed under|released under", ["CASELESS"]),
    (54, r"\bthe\b", [SOM]),
]
# several literals each, all of which must occur
FACTORS = [
    (70, r"the[\s\S]*(?:that|this)?[\s\S]*license", ["CASELESS"]),
    (71, r"ing [\s\S]*tion[\s\S]*\.com", []),
    (72, r"user[\w.]*@example\.com", []),
]
UNICODE = [
    (61, r"\bé\w+", ["UTF8", "UCP"]),
    (62, r"\bÉ\w+", ["UTF8", "UCP", "CASELESS"]),
    (63, r"\d\W\w", ["UTF8", "UCP"]),
]
OPTIONAL_GROUPS = [
    *GROUPS,
    (3, r"qu(e)?(s|r)?", []),
    (4, r"((T)he|(A)nd) (o(f|n))?", []),
]
BYTES = [
    (0, r"qu[ae]", [SOM]),
    (1, r"the", [SOM, "CASELESS"]),
    (2, r"é", [SOM, "UTF8"]),
    (3, r"é", [SOM]),
]
COMBINED = [(100, "2 & (6 | !0)"), (101, "!1 & !2 & !12"), (102, "3 | 4 | 5"), (103, "!11")]
QUIET_IDS = {0, 6, 10, 12}
EVENT_RULES = [
    (0, r'"k": [0-9]}', [SOM]),
    (1, r'"k": [1-3][0-9]}', [SOM]),
    (2, r'"k": (?:7|8)', [SOM]),
]
EVENT_COMBINED = [(10, "0 & 1"), (11, "2 & !0"), (12, "!0 & !1 & !2")]

CONV = ["conv_id", "turn"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread_small_input(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _rules(triples, quiet=frozenset(), dialect="direct"):
    return [rule(p, [*flags, *(["QUIET"] if i in quiet else [])], i, dialect=dialect) for i, p, flags in triples]


def _ruleset(name: str) -> list[dict]:
    sets = {
        "personal": lambda: _rules(PERSONAL_DATA),
        "words": lambda: _rules(WORDS),
        "ends": lambda: _rules([(i, p, [f for f in flags if f != SOM]) for i, p, flags in PERSONAL_DATA]),
        "all": lambda: _rules(PERSONAL_DATA + WORDS),
        "names": lambda: _rules(NAMES),
        "runs": lambda: _rules(RUNS),
        "flags": lambda: _rules(FLAG_CASES),
        "groups": lambda: _rules(GROUPS, dialect="java"),
        "optional_groups": lambda: _rules(OPTIONAL_GROUPS, dialect="java"),
        "java": lambda: _rules(PERSONAL_DATA, dialect="java"),
        "props": lambda: [rule(r'"k": (\d)(\d?)', [], 0, dialect="java")],
        "bytes": lambda: _rules(BYTES),
        "url": lambda: _rules([(0, "a[a-z]", [SOM]), (1, "[0-9]+/", [SOM])]),
        "combined": lambda: _rules(PERSONAL_DATA + WORDS, QUIET_IDS) + [
            rule(p, "COMBINATION", i) for i, p in COMBINED],
        "bounded": lambda: _rules(BOUNDED),
        "factors": lambda: _rules(FACTORS, dialect="java"),
        "single": lambda: _rules([(i, p, [*f, "SINGLEMATCH"]) for i, p, f in NAMES]),
        "empty": lambda: _rules([(60, "[aeiou]*", [SOM, "UTF8", "ALLOWEMPTY"])]),
        "unicode": lambda: _rules(UNICODE),
        "repeats": lambda: _rules(REPEATS),
        "swept": lambda: _rules([r for r in PERSONAL_DATA + WORDS if r[0] in SWEPT_IDS], {10}) + [
            rule(p, "COMBINATION", i) for i, p in SWEPT_COMBINED],
        "events": lambda: _rules(EVENT_RULES) + [rule(p, "COMBINATION", i) for i, p in EVENT_COMBINED],
        "tags": lambda: [
            rule(p, [SOM, "CASELESS"], i, ruleset=s) for s, i, p in TAG_SETS],
    }
    return sets[name]()


_compiled: dict = {}


def compiled(spark: SparkSession, name: str, **bounds):
    """A ruleset is compiled once per application and then used by many scans."""
    known = (spark.sparkContext.applicationId, name, *bounds.items())
    if known not in _compiled:
        _compiled[known] = compile_rules(rules_table(spark, _ruleset(name)), **bounds)
    return _compiled[known]


TAG_SETS = [("links", 0, '<a href="/'), ("links", 1, "https?://"), ("blocks", 0, "<li>"), ("blocks", 1, '<div class="ad">')]


def hits_by_lang(spark, sf_dir):
    found = hits(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id", keep=["lang"])
    return found.groupBy("rule_id", "lang").agg(F.count("*").alias("n_docs"))


def scan_hits(spark, sf_dir):
    return hits(table(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id")


def has_match(spark, sf_dir):
    return any_match(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id").select("doc_id", "lang")


def no_match_documents(spark, sf_dir):
    return no_match(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id").select("doc_id", "lang")


def has_match_flag(spark, sf_dir):
    return with_has_match(table(spark, sf_dir, "pages"), compiled(spark, "words"), "html").select("page_id", "has_match")


def has_match_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("data"))
    return any_match(docs, compiled(spark, "bytes"), "doc_id", "data", byte_scan=True).select("doc_id")


def match_counts_by_lang(spark, sf_dir):
    return match_counts(table(spark, sf_dir, "documents"), compiled(spark, "all"), "lang")


def find_spans_codepoint(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id",
                semantics="find", offset_unit="codepoint")


def find_spans_utf16(spark, sf_dir):
    text = F.concat(F.lit("\U0001F600 "), F.col("text"), F.lit(" \U0001D11E the"))
    docs = table(spark, sf_dir, "conversations").select(*CONV, text.alias("text"))
    return scan(docs, compiled(spark, "words"), CONV, semantics="find")


def find_spans_byte(spark, sf_dir):
    return scan(table(spark, sf_dir, "conversations"), compiled(spark, "words"), CONV,
                semantics="find", offset_unit="byte")


def all_end_matches(spark, sf_dir):
    return scan(table(spark, sf_dir, "part"), compiled(spark, "names"), "p_partkey", "p_name")


def all_end_matches_documents(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), compiled(spark, "runs"), "doc_id", offset_unit="codepoint")


def all_end_matches_spread(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), compiled(spark, "runs"), "doc_id",
                offset_unit="codepoint", spread=True)


def all_end_matches_repeats(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), compiled(spark, "repeats"), "doc_id", offset_unit="codepoint")


def combination_events_documents(spark, sf_dir):
    return combination_events(table(spark, sf_dir, "documents"), compiled(spark, "swept"), "doc_id", offset_unit="codepoint")


def single_match(spark, sf_dir):
    return single_matches(table(spark, sf_dir, "part"), compiled(spark, "names"), "p_partkey", "p_name")


def single_match_flag(spark, sf_dir):
    return scan(table(spark, sf_dir, "part"), compiled(spark, "single"), "p_partkey", "p_name")


def empty_matches(spark, sf_dir):
    return scan(table(spark, sf_dir, "part"), compiled(spark, "empty"), "p_partkey", "p_name", with_is_empty=True)


def unicode_classes(spark, sf_dir):
    return hits(table(spark, sf_dir, "documents"), compiled(spark, "unicode"), "doc_id")


def match_counts_own(spark, sf_dir):
    """Every end counts, one match where the flag says so."""
    part = table(spark, sf_dir, "part")
    every = match_counts(part, compiled(spark, "names"), "p_brand", "p_name", semantics="own")
    one = match_counts(part, compiled(spark, "single"), "p_brand", "p_name", semantics="own")
    return every.withColumn("single", F.lit(False)).unionByName(one.withColumn("single", F.lit(True)))


def handled_matches(spark, sf_dir):
    """Matches given to a handler on the executors, which counts what it gets."""
    seen, letters = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def handler(rows):
        for r in rows:
            seen.add(1)
            letters.add(r.end - r.start + 1)

    for_each_match(scan(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id", semantics="find", offset_unit="codepoint"), handler)
    return spark.createDataFrame([(seen.value, letters.value)], "n_matches long, n_chars long")


def listed_matches(spark, sf_dir):
    """The nested match list of each text, written out in order."""
    nested = matches_per_text(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id", semantics="find", offset_unit="codepoint")
    in_order = F.array_sort(F.transform("matches", lambda m: F.struct(m["rule_id"].alias("i"), m["start"].alias("s"), m["end"].alias("e"), m["matched"].alias("m"))))
    return nested.select("doc_id", F.array_join(F.transform(in_order, lambda m: F.concat_ws("|", m["i"].cast("string"), m["s"].cast("string"), m["e"].cast("string"), m["m"])), "\n").alias("matches"))


def ordered_tags(spark, sf_dir):
    """Two rulesets with the same ids, in one order; and which of them can match at all."""
    return ordered_matches(table(spark, sf_dir, "pages"), compiled(spark, "tags"), "page_id", "html", with_ruleset=True, semantics="find", offset_unit="codepoint")


def candidate_tags(spark, sf_dir):
    pages, rules = table(spark, sf_dir, "pages"), compiled(spark, "tags")
    return candidates(pages, rules, "page_id", "html", with_ruleset=True).drop("filterable").withColumn("kind", F.lit("candidate")).unionByName(
        confirmed(pages, rules, "page_id", "html", with_ruleset=True).withColumn("kind", F.lit("confirmed")))


def matches_as_list(spark, sf_dir):
    nested = matches_per_text(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id",
                              semantics="find")
    return nested.select("doc_id", F.size("matches").alias("n_matches"))


def ordered(spark, sf_dir):
    return ordered_matches(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id", semantics="find")


def first_three(spark, sf_dir):
    return first_k(table(spark, sf_dir, "conversations"), compiled(spark, "words"), CONV, 3, semantics="find")


def take_until_the(spark, sf_dir):
    return take_until(table(spark, sf_dir, "conversations"), compiled(spark, "words"), CONV,
                      lambda m: m["rule_id"] == 10, semantics="find")


def selected_matches(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id",
                 semantics="find", offset_unit="codepoint")
    return found.where((F.col("end") - F.col("start") >= 11) & F.col("matched").startswith("T"))


def combination(spark, sf_dir):
    return combinations(table(spark, sf_dir, "documents"), compiled(spark, "combined"), "doc_id")


def hits_per_text(spark, sf_dir):
    found = rule_hits_per_text(table(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id")
    return found.select("doc_id", F.array_join("hits", ",").alias("hits"))


def quiet_scan(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"), compiled(spark, "combined"), "doc_id", semantics="find")
    return found.groupBy("doc_id", "rule_id").agg(F.count("*").alias("n_matches"))


def prefilter_candidates(spark, sf_dir):
    return candidates(table(spark, sf_dir, "documents"), compiled(spark, "java"), "doc_id")


def prefilter_factors(spark, sf_dir):
    """Texts that hold all literals of a rule; the rarest one in a sample of texts is looked for first."""
    docs = table(spark, sf_dir, "documents")
    return candidates(docs, choose_factors(compiled(spark, "factors"), docs), "doc_id")


def prefilter_confirmed(spark, sf_dir):
    return confirmed(table(spark, sf_dir, "documents"), compiled(spark, "java"), "doc_id")


def full_matches(spark, sf_dir):
    return confirmed(table(spark, sf_dir, "part"), compiled(spark, "names"), "p_partkey", "p_name", full_match=True)


def captured_groups(spark, sf_dir):
    return capture_groups(table(spark, sf_dir, "documents"), compiled(spark, "groups"), "doc_id")


def group_offsets(spark, sf_dir):
    return group_spans(table(spark, sf_dir, "documents"), compiled(spark, "optional_groups"), "doc_id", offset_unit="codepoint")


def captured_props(spark, sf_dir):
    return capture_groups(table(spark, sf_dir, "events"), compiled(spark, "props"), "event_id", "props")


def alternation(spark, sf_dir):
    return any_match_alternation(table(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id")


def byte_scan(spark, sf_dir):
    blobs = table(spark, sf_dir, "conversations").select(*CONV, F.encode("text", "UTF-8").alias("data"))
    return scan(blobs, compiled(spark, "bytes"), CONV, "data", byte_scan=True).select(*CONV, "rule_id", "start", "end")


def byte_slice_scan(spark, sf_dir):
    data = byte_slice(F.encode("url", "UTF-8"), 4, 30)
    blobs = table(spark, sf_dir, "pages").select("page_id", data.alias("data"))
    return scan(blobs, compiled(spark, "url"), "page_id", "data", byte_scan=True).select(
        "page_id", "rule_id", "start", "end")


def flag_matrix(spark, sf_dir):
    return hits(table(spark, sf_dir, "documents"), compiled(spark, "flags"), "doc_id")


def java_flag_matrix(spark, sf_dir):
    regexes = spark.createDataFrame(JAVA_CASES, "id int, pattern string, options int")
    rules = compile_rules(rules_from_regex(regexes, "pattern", "options", "id"))
    return confirmed(table(spark, sf_dir, "documents"), rules, "doc_id")


def rule_lookup(spark, sf_dir):
    found = hits(table(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id")
    asked = found.withColumn("rule_id", F.when(F.col("rule_id") == 5, F.lit(99)).otherwise(F.col("rule_id")))
    return lookup_rules(asked, compiled(spark, "all"), ["pattern"])


def multi_ruleset(spark, sf_dir):
    counts = match_counts(table(spark, sf_dir, "pages"), compiled(spark, "tags"), "page_id", "html", with_ruleset=True)
    return counts.select("page_id", "ruleset", "rule_id", "n_matches")


def untracked_starts(spark, sf_dir):
    """Rules that do not track starts: only ends are reported."""
    return scan(table(spark, sf_dir, "documents"), compiled(spark, "ends"), "doc_id", semantics="find")


def saved_rules_scan(spark, sf_dir):
    """Rules written, read again, compiled and searched for."""
    path = work_folder(spark, "rules")
    save_rules(rules_table(spark, _ruleset("personal")), path)
    return hits(table(spark, sf_dir, "documents"), compile_rules(load_rules(spark, path)), "doc_id")


def reloaded_rules_scan(spark, sf_dir):
    """Rules saved with all that was derived from them, and read again without deriving anything."""
    path = work_folder(spark, "compiled")
    save_compiled(rules_table(spark, _ruleset("all")), path)
    return hits(table(spark, sf_dir, "documents"), load_compiled(spark, path), "doc_id")


def file_blocks_scan(spark, sf_dir):
    """The documents as plain files, scanned in small blocks; matches per rule over all files."""
    path = work_folder(spark, "files")
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").write.text(path)
    found = scan_files(spark, path, compiled(spark, "bounded"), block_bytes=1 << 16)
    return found.groupBy("rule_id").agg(F.count("*").alias("n_matches"), F.sum(F.col("end") - F.col("start")).alias("n_bytes")).select(
        "rule_id", "n_matches", F.when(F.col("rule_id") != 53, F.col("n_bytes")).alias("n_bytes"))


def _word_rules(spark, sf_dir, **bounds):
    """Every long word of `benchmark` as a caseless rule, one ruleset per first letter."""
    words = (table(spark, sf_dir, "benchmark")
             .select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{9,}"), F.lit(0))).alias("w"))
             .select(F.lower("w").alias("pattern")).distinct())
    numbered = with_positional_ids(words.select(
        F.lit(None).cast("int").alias("rule_id"), "pattern", F.substring("pattern", 1, 1).alias("ruleset"),
        F.col("pattern").alias("pos"))).drop("pos")
    return compile_rules(rules_from_df(numbered.withColumn("flags", F.array(F.lit("CASELESS")))), **bounds)


def _word_hits(spark, sf_dir, **bounds):
    rules = _word_rules(spark, sf_dir, **bounds)
    found = hits(table(spark, sf_dir, "documents"), rules, "doc_id", with_ruleset=True)
    return lookup_rules(found, rules, ["pattern"]).select("doc_id", "pattern")


def many_rules(spark, sf_dir):
    return _word_hits(spark, sf_dir)


def many_rules_joined(spark, sf_dir):
    return _word_hits(spark, sf_dir, max_rules=0)


def many_rules_any_match(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return any_match(docs, _word_rules(spark, sf_dir), "doc_id").select("doc_id")


def _part_rules(spark, sf_dir) -> DataFrame:
    """Part names turned into rules, some of them unusable, by part type."""
    name = F.col("p_name")
    shape = {
        "ECONOMY": F.concat(name, F.lit("(")),
        "SMALL": F.concat(name, F.lit("++")),
        "LARGE": F.concat(F.lit("("), name, F.lit(r")\1")),
        "PROMO": F.concat(F.lit("(?:"), name, F.lit(")*")),
        "STANDARD": F.concat(F.lit("(?:"), name, F.lit(")*")),
    }
    pattern = name
    for kind, value in shape.items():
        pattern = F.when(F.col("p_type") == kind, value).otherwise(pattern)
    flags = F.when(F.col("p_type") == "STANDARD", F.array(F.lit("ALLOWEMPTY"), F.lit("UTF8"))).when(
        F.col("p_type") == "SMALL", F.array(F.lit("UTF8"), F.lit("CASELESS"), F.lit("UTF8"))).otherwise(
        F.array(F.lit("NO_FLAG")))
    return rules_from_df(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rule_id"), pattern.alias("pattern"), flags.alias("flags"),
        F.col("p_brand").alias("ruleset"), F.col("p_partkey").alias("pos")))


def rule_validation(spark, sf_dir):
    return validate_rules(_part_rules(spark, sf_dir)).select("rule_id", "is_valid", "error")


def duplicate_rule_ids(spark, sf_dir):
    rules = rules_from_df(table(spark, sf_dir, "part").select(
        F.col("p_size").alias("rule_id"), F.col("p_name").alias("pattern"), F.col("p_brand").alias("ruleset")))
    return duplicate_ids(rules)


def positional_ids(spark, sf_dir):
    rules = _part_rules(spark, sf_dir).withColumn("rule_id", F.lit(None).cast("int"))
    return with_positional_ids(rules).select("ruleset", "pos", "rule_id")


def ruleset_roundtrip(spark, sf_dir):
    path = work_folder(spark, "rules")
    save_rules(_part_rules(spark, sf_dir), path)
    return load_rules(spark, path).select(
        "rule_id", "pattern", F.array_join("flags", ",").alias("flags"), "dialect", "ruleset")


def flag_bits(spark, sf_dir):
    return with_flag_bits(_part_rules(spark, sf_dir)).select("rule_id", "flag_bits")


def normalized_rules(spark, sf_dir):
    return normalized(_part_rules(spark, sf_dir)).select("rule_id", F.array_join("flags", ",").alias("flags"))


def changed_rules(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    old = rules_from_df(part.where("p_type <> 'SMALL'").select(
        F.col("p_partkey").alias("rule_id"), F.col("p_name").alias("pattern")))
    new = rules_from_df(part.where("p_type <> 'LARGE'").select(
        F.col("p_partkey").alias("rule_id"),
        F.when(F.col("p_type") == "PROMO", F.concat_ws("|", "p_name", "p_brand")).otherwise(F.col("p_name"))
        .alias("pattern")))
    return ruleset_diff(old, new)


def _odd_ids(spark, sf_dir) -> DataFrame:
    """Part names as rulesets by brand whose ids are partly missing, negative or repeated."""
    part = table(spark, sf_dir, "part")
    odd = F.when(F.col("p_type") == "PROMO", F.lit(None).cast("int")).when(F.col("p_type") == "SMALL", -F.col("p_partkey").cast("int")).when(
        F.col("p_type") == "LARGE", F.col("p_size").cast("int")).otherwise(F.col("p_partkey").cast("int") + 1000)
    return rules_from_df(part.select(odd.alias("rule_id"), F.col("p_name").alias("pattern"), F.col("p_brand").alias("ruleset")))


def problems_of_rulesets(spark, sf_dir):
    return ruleset_problems(_odd_ids(spark, sf_dir))


def equal_rulesets(spark, sf_dir):
    """Rulesets by brand against themselves with flags in another form and, for some, a rule changed."""
    rules = _part_rules(spark, sf_dir)
    other = rules.withColumn("flags", F.concat(F.reverse("flags"), F.array(F.lit("NO_FLAG")))).withColumn(
        "pattern", F.when(F.col("rule_id") % 50 == 7, F.concat("pattern", F.lit("x"))).otherwise(F.col("pattern")))
    return same_rulesets(rules, other)


def counted_rules(spark, sf_dir):
    return rule_counts(_part_rules(spark, sf_dir))


def cleaned_prefixes(spark, sf_dir):
    """Texts cut at half their bytes: what is left of a broken character becomes U+FFFD."""
    cut = F.substring(F.encode("text", "UTF-8"), F.lit(1), F.floor(F.octet_length("text") / 2).cast("int"))
    return table(spark, sf_dir, "conversations").select(*CONV, clean_utf8(cut).alias("cleaned"))


def offset_conversion(spark, sf_dir):
    half = F.floor(F.length("text") / 2)
    size = F.octet_length("text")
    return table(spark, sf_dir, "conversations").select(
        *CONV,
        convert_offset(F.col("text"), half, "byte").alias("byte_offset"),
        convert_offset(F.col("text"), half, "utf16").alias("utf16_offset"),
        byte_to_char(F.col("text"), F.floor(size / 2).cast("int")).alias("char_at_half"))


def clean_utf8_prefixes(spark, sf_dir):
    data = F.encode("text", "UTF-8")
    cut = F.substring(data, F.lit(1), F.floor(F.octet_length("text") / 2).cast("int"))
    return table(spark, sf_dir, "conversations").select(*CONV, is_clean_utf8(cut).alias("clean"))


def _stream(spark, sf_dir, name):
    return read_stream(spark, f"{sf_dir}/{name}.parque[t]", spark.read.parquet(f"{sf_dir}/{name}.parquet").schema)


def stream_scan(spark, sf_dir):
    return run_available(stream_hits(_stream(spark, sf_dir, "documents"), compiled(spark, "all"), "doc_id"), "hits")


def stream_spans(spark, sf_dir):
    found = scan(_stream(spark, sf_dir, "documents"), compiled(spark, "personal"), "doc_id",
                 semantics="find", offset_unit="codepoint")
    return run_available(found, "spans")


def stream_single_alert(spark, sf_dir):
    alerts = single_alerts(_stream(spark, sf_dir, "events"), compiled(spark, "events"), "user_id", "ts", "60 days",
                           "props")
    return run_available(alerts.select("user_id", "rule_id"), "alerts")


def stream_large_hits(spark, sf_dir):
    """A ruleset beyond the size bound over a stream: each micro-batch is a table."""
    rules, path = compiled(spark, "all", max_rules=0), work_folder(spark, "large-hits")
    deliver_results(_stream(spark, sf_dir, "documents"), lambda batch: hits(batch, rules, "doc_id"), path, path + "-checkpoint").awaitTermination()
    return delivered(spark, path, "doc_id bigint, rule_id int")


def stream_alerts_once(spark, sf_dir):
    """The events in several batches: one alert per user and rule for good, with no watermark."""
    path = work_folder(spark, "alerts")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{path}/events")
    stream = read_stream(spark, f"{path}/events", events.schema, maxFilesPerTrigger=1)
    deliver_once(stream, lambda batch: hits(batch, compiled(spark, "events"), "user_id", "props"), f"{path}/alerts", f"{path}/checkpoint",
                 ["user_id", "rule_id"]).awaitTermination()
    return delivered(spark, f"{path}/alerts", f"user_id {dict(events.dtypes)['user_id']}, rule_id int")


def windowed_matches(spark, sf_dir):
    counts = windowed_counts(_stream(spark, sf_dir, "events"), compiled(spark, "events"), "event_id", "ts",
                             "1 hour", "1 hour", "props")
    return run_available(counts, "windows").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "rule_id", "n_hits")


def session_combination(spark, sf_dir):
    found = session_combinations(_stream(spark, sf_dir, "events"), compiled(spark, "events"), "user_id", "ts",
                                 "1 hour", "2 hours", "props")
    return run_available(found, "sessions").select(
        "user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "rule_id")


def windowed_matches_whole(spark, sf_dir):
    """The same operator over an input that ends: no window is left open."""
    counts = windowed_counts(table(spark, sf_dir, "events"), compiled(spark, "events"), "event_id", "ts", "1 hour", "1 hour", "props")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "rule_id", "n_hits")


def session_combination_whole(spark, sf_dir):
    found = session_combinations(table(spark, sf_dir, "events"), compiled(spark, "events"), "user_id", "ts", "1 hour", "2 hours", "props")
    return found.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "rule_id")


# rulesets beyond the size bound, over texts whose keys repeat and are NULL: the same rows as below it
def _repeated_keys(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3))


def large_no_match(spark, sf_dir):
    return no_match(_repeated_keys(spark, sf_dir), compiled(spark, "personal", max_rules=0), "doc_id").select("doc_id", "lang")


def large_flag(spark, sf_dir):
    flagged = with_has_match(_repeated_keys(spark, sf_dir), compiled(spark, "personal", max_rules=0))
    return flagged.select("doc_id", "lang", "has_match")


def large_combination(spark, sf_dir):
    return combinations(table(spark, sf_dir, "documents"), compiled(spark, "combined", max_rules=0), "doc_id")


def large_first_k(spark, sf_dir):
    return first_k(table(spark, sf_dir, "conversations"), compiled(spark, "words", max_rules=0), CONV, 3, semantics="find")


QUERIES = {
    "hits_by_lang": hits_by_lang,
    "scan_hits": scan_hits,
    "has_match": has_match,
    "no_match": no_match_documents,
    "has_match_flag": has_match_flag,
    "has_match_bytes": has_match_bytes,
    "match_counts_by_lang": match_counts_by_lang,
    "find_spans_codepoint": find_spans_codepoint,
    "find_spans_utf16": find_spans_utf16,
    "find_spans_byte": find_spans_byte,
    "all_end_matches": all_end_matches,
    "all_end_matches_documents": all_end_matches_documents,
    "all_end_matches_spread": all_end_matches_spread,
    "all_end_matches_repeats": all_end_matches_repeats,
    "combination_events": combination_events_documents,
    "single_match_flag": single_match_flag,
    "empty_matches": empty_matches,
    "unicode_classes": unicode_classes,
    "match_counts_own": match_counts_own,
    "handled_matches": handled_matches,
    "listed_matches": listed_matches,
    "ordered_tags": ordered_tags,
    "candidate_tags": candidate_tags,
    "ruleset_problems": problems_of_rulesets,
    "equal_rulesets": equal_rulesets,
    "rule_counts": counted_rules,
    "cleaned_prefixes": cleaned_prefixes,
    "single_match": single_match,
    "matches_as_list": matches_as_list,
    "ordered_matches": ordered,
    "first_k": first_three,
    "take_until": take_until_the,
    "selected_matches": selected_matches,
    "combination": combination,
    "hits_per_text": hits_per_text,
    "quiet": quiet_scan,
    "prefilter_candidates": prefilter_candidates,
    "prefilter_factors": prefilter_factors,
    "prefilter_confirmed": prefilter_confirmed,
    "full_matches": full_matches,
    "capture_groups": captured_groups,
    "capture_groups_events": captured_props,
    "group_spans": group_offsets,
    "any_match_alternation": alternation,
    "byte_scan": byte_scan,
    "byte_slice_scan": byte_slice_scan,
    "flag_matrix": flag_matrix,
    "java_flag_matrix": java_flag_matrix,
    "rule_lookup": rule_lookup,
    "multi_ruleset": multi_ruleset,
    "many_rules": many_rules,
    "many_rules_joined": many_rules_joined,
    "many_rules_any_match": many_rules_any_match,
    "validate_rules": rule_validation,
    "duplicate_rule_ids": duplicate_rule_ids,
    "positional_ids": positional_ids,
    "ruleset_roundtrip": ruleset_roundtrip,
    "flag_bits": flag_bits,
    "normalized_rules": normalized_rules,
    "ruleset_diff": changed_rules,
    "offset_conversion": offset_conversion,
    "clean_utf8_prefixes": clean_utf8_prefixes,
    "untracked_starts": untracked_starts,
    "saved_rules_scan": saved_rules_scan,
    "reloaded_rules_scan": reloaded_rules_scan,
    "file_blocks_scan": file_blocks_scan,
    "windowed_matches_whole": windowed_matches_whole,
    "session_combination_whole": session_combination_whole,
    "large_no_match": large_no_match,
    "large_flag": large_flag,
    "large_combination": large_combination,
    "large_first_k": large_first_k,
    "stream_scan": stream_scan,
    "stream_spans": stream_spans,
    "stream_large_hits": stream_large_hits,
    "stream_alerts_once": stream_alerts_once,
    "stream_single_alert": stream_single_alert,
    "windowed_matches": windowed_matches,
    "session_combination": session_combination,
}
