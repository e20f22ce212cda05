"""One behaviour at every ruleset size: each operator with the bound at zero against the plain one."""

import pytest
from pyspark.sql import functions as F

from sieveflow import (
    any_match, any_match_alternation, candidates, capture_groups, combinations, compile_rules, confirmed, first_k, hits,
    match_counts, matches_per_text, no_match, ordered_matches, rule, rules_table, scan, single_matches, take_until, with_has_match,
)
from sieveflow.operators.combine import rule_hits_per_text
from sieveflow.operators.validate import RuleError
from sieveflow.sources.rules import rules_from_df, with_positional_ids
from sieveflow.streaming.streams import run_available, session_combinations, single_alerts, windowed_counts

SOM = "SOM_LEFTMOST"
RULES = [
    rule("harbour", [SOM, "CASELESS"], 0), rule("sea|lake", [SOM], 1), rule(r"\d{3}", [SOM], 2), rule("a.c", [SOM], 3),
    rule("quiet", ["QUIET"], 4), rule("0 & !1", "COMBINATION", 10), rule("!0 & !1 & !2", "COMBINATION", 11),
    rule("harbour", [SOM, "UTF8"], 0, ruleset="B"), rule("é(.)", (), 1, ruleset="B"),
]
TEXTS = [
    (1, "Harbour by the sea, harbour"), (1, "Harbour"), (None, "harbour 123"), (None, None), (2, ""), (2, "xé1 aéc quiet lake"),
    (3, "nothing"), (1, "Harbour"), (4, "quiet only"), (5, "0123 abc harbour lake"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id int, text string")


@pytest.fixture(scope="module")
def both(spark):
    table = rules_table(spark, RULES)
    return compile_rules(table), compile_rules(table, max_rules=0)


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


OPERATORS = {
    "hits": lambda t, c: hits(t, c, "doc_id", with_ruleset=True),
    "scan": lambda t, c: scan(t, c, "doc_id", with_ruleset=True),
    "find": lambda t, c: scan(t, c, "doc_id", semantics="find"),
    "any": lambda t, c: any_match(t, c, "doc_id"),
    "none": lambda t, c: no_match(t, c, "doc_id"),
    "flag": with_has_match,
    "order": lambda t, c: ordered_matches(t, c, "doc_id"),
    "first": lambda t, c: first_k(t, c, "doc_id", 2),
    "until": lambda t, c: take_until(t, c, "doc_id", lambda m: m["rule_id"] == 1),
    "single": lambda t, c: single_matches(t, c, "doc_id"),
    "counts": lambda t, c: match_counts(t, c, "doc_id", with_ruleset=True),
    "combinations": lambda t, c: combinations(t, c, "doc_id"),
    "per text": lambda t, c: rule_hits_per_text(t, c, "doc_id"),
    "confirmed": lambda t, c: confirmed(t, c, "doc_id"),
    "groups": lambda t, c: capture_groups(t, c, "doc_id"),
    "candidates": lambda t, c: candidates(t, c, "doc_id"),
    "alternation": lambda t, c: any_match_alternation(t, c, "doc_id"),
    "nested": lambda t, c: matches_per_text(t, c, "doc_id").select("doc_id", F.size("matches")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_same_rows(texts, both, name):
    small, large = (rows(OPERATORS[name](texts, c)) for c in both)
    assert small == large and small


def test_compiled_size_counts_too(spark):
    table = rules_table(spark, [rule("ab" * 50, (), i) for i in range(20)])
    large = compile_rules(table, max_bytes=2500)
    assert compile_rules(table).fits and not large.fits
    assert large.kept.is_cached
    large.release()
    assert not large.kept.is_cached


def test_streams_refuse_what_would_need_state_without_limit(spark, tmp_path, both):
    spark.createDataFrame(TEXTS, "doc_id int, text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id int, text string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="stream"):
        hits(stream, both[1], "doc_id")


def test_quiet_rules_and_rulesets_are_counted_apart(texts, both):
    got = {(r.ruleset, r.rule_id): (r.n_matches, r.n_texts) for r in match_counts(texts, both[0], with_ruleset=True).collect()}
    assert (None, 4) not in got and got[None, 0] == (6, 5) and got["B", 0] == (3, 3)


def test_groups_of_a_rule_that_sees_bytes(texts, both):
    got = capture_groups(texts, both[0], "doc_id").where("rule_id = 1 AND doc_id = 2").collect()
    assert {(r.group_no, r.value) for r in got} >= {(0, "é1"), (1, "1"), (0, "éc"), (1, "c")}


def test_alerts_windows_and_sessions_by_ruleset(spark, both, tmp_path):
    events = spark.createDataFrame([(1, "harbour", "2024-01-01 00:10:00"), (1, "harbour", "2024-01-01 00:20:00")],
                                   "user int, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    alerts = run_available(single_alerts(stream, both[0], "user", "ts", "1 hour", with_ruleset=True))
    assert sorted(str(r.ruleset) for r in alerts.collect()) == ["B", "None"]
    counts = windowed_counts(events, both[0], "user", "ts", "1 hour", "1 hour", with_ruleset=True).collect()
    assert {(r.ruleset, r.rule_id): r.n_hits for r in counts} == {(None, 0): 2, ("B", 0): 2}
    sessions = session_combinations(events, both[0], "user", "ts", "1 hour", "1 hour").collect()
    assert [(r.user, r.rule_id) for r in sessions] == [(1, 10)]


@pytest.mark.parametrize("pattern", ["(" * 40 + "0" + ")" * 40, "!" * 40 + "0", "(" * 20 + "0 & " + "!" * 20 + "(1 | 0)" + ")" * 20])
def test_combinations_nest_as_deep_as_they_like(spark, pattern):
    compiled = compile_rules(rules_table(spark, [rule("a", (), 0), rule("b", (), 1), rule(pattern, "COMBINATION", 2)]))
    got = combinations(spark.createDataFrame([(1, "ab")], "doc_id int, text string"), compiled, "doc_id").collect()
    assert [r.rule_id for r in got] == [2]


def test_all_bad_rules_are_named_at_every_size(spark):
    table = rules_table(spark, [rule("(", (), i) for i in range(150)])
    for bound in (50_000, 0):
        with pytest.raises(RuleError) as found:
            compile_rules(table, max_rules=bound)
        assert found.value.n_failed == 150
        assert (found.value.table.count() if found.value.table is not None else len(found.value.failed_rules)) == 150
    with pytest.raises(RuleError, match="unknown rules"):
        compile_rules(rules_table(spark, [rule("a", (), 0), rule("0 & 7", "COMBINATION", 1)]), max_rules=0)


@pytest.mark.parametrize("places", [[None, None], [0, 0], [0, None]])
def test_positions_must_be_given(spark, places):
    df = spark.createDataFrame([(f"a{i}", p) for i, p in enumerate(places)], "pattern string, pos int")
    with pytest.raises(ValueError, match="pos"):
        with_positional_ids(rules_from_df(df))


def test_positions_with_gaps(spark):
    df = spark.createDataFrame([("a", 5), ("b", 2), ("c", 9)], "pattern string, pos int")
    assert {r.pattern: r.rule_id for r in with_positional_ids(rules_from_df(df)).collect()} == {"b": 0, "a": 1, "c": 2}


def test_canonical_equivalence_is_refused(spark):
    with pytest.raises(RuleError, match="CANON_EQ"):
        compile_rules(rules_table(spark, [rule("a", ["CANON_EQ"], 0, dialect="java")]))


@pytest.mark.parametrize("most", [1, 1 << 11])
def test_grams_are_cut_out_only_where_one_begins(spark, monkeypatch, most):
    """With few or no beginnings allowed rows are the same; with enough, places without a gram give nothing."""
    from sieveflow.operators import large
    monkeypatch.setattr(large, "MAX_BEGINNINGS", most)
    rules = rules_table(spark, [rule(p, ["CASELESS", "UTF8"], i) for i, p in enumerate(
        ["needle", "need less", r"a\.b", r"\[x\]", "é日é", "😀!", "zz"])])
    texts = ["a needle", "NEED LESS", "needless", "axb a.b", "[x]", "É日é", "😀! ", "zzz", "", None, "haystack " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = {(0, 0), (1, 1), (2, 0), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6)}
    for bounds in ({}, {"max_rules": 0}):
        compiled = compile_rules(rules, **bounds)
        assert {(r.id, r.rule_id) for r in hits(docs, compiled, "id").collect()} == want
    filed = large.rule_grams(compiled.table)
    found = large.text_grams(docs.where("id = 10").select(F.lit("t").alias(large.TID), F.col("text").alias(large.TEXT)), large.gram_places(filed), lambda g: F.lit(True))
    assert (found.count() > 0) == (most < 4)
