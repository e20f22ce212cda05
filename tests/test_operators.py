import pytest
from pyspark.sql import functions as F

from sieveflow import (
    any_match, any_match_alternation, candidates, capture_groups, combination_events, combinations, compile_rules, confirmed, first_k,
    for_each_match, hits, lookup_rules, match_counts, matches_per_text, no_match, ordered_matches, rule, rules_table,
    scan, single_matches, take_until, with_has_match, work_folder, write_matches,
)

SOM = "SOM_LEFTMOST"
BASE = [
    rule("lamp", [SOM, "CASELESS"], 0), rule("lamp7", SOM, 1), rule("lamp9", SOM, 2),
    rule("river", SOM, 3), rule("山川", [SOM, "UTF8"], 4),
]


@pytest.fixture(scope="module")
def base(spark):
    return compile_rules(rules_table(spark, BASE))


def docs(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


def test_any_and_no_match(spark, base):
    texts = docs(spark, "Lamp", "One lamp of ours", "And a third LAMP", "山川 river", "A door and a window",
                 "Here is none", "")
    assert sorted(r.doc_id for r in any_match(texts, base, "doc_id").collect()) == [0, 1, 2, 3]
    assert sorted(r.doc_id for r in no_match(texts, base, "doc_id").collect()) == [4, 5, 6]
    flags = {r.doc_id: r.has_match for r in with_has_match(texts, base).collect()}
    assert flags == {i: i < 4 for i in range(7)}
    assert sorted(r.doc_id for r in any_match_alternation(texts, base, "doc_id").collect()) == [0, 1, 2, 3]


def test_empty_rule_matches_everything(spark):
    compiled = compile_rules(rules_table(spark, [rule("a|", "ALLOWEMPTY", 400)]))
    assert any_match(docs(spark, "bbbbbbb", ""), compiled, "doc_id").count() == 2


def test_stop_after_first(spark, base):
    rows = first_k(docs(spark, "Lamp shade 123 river"), base, "doc_id", 1).collect()
    assert [(r.rule_id, r.start, r.end) for r in rows] == [(0, 0, 3)]


def test_order_and_take_until(spark, base):
    texts = docs(spark, "lamp lamp7 river lamp9", "nothing")
    rows = sorted(ordered_matches(texts, base, "doc_id").collect(), key=lambda r: r.seq)
    assert [(r.seq, r.rule_id, r.end) for r in rows] == [
        (0, 0, 3), (1, 0, 8), (2, 1, 9), (3, 3, 15), (4, 0, 20), (5, 2, 21)]
    kept = take_until(texts, base, "doc_id", lambda m: m["rule_id"] == 1).collect()
    assert sorted((r.rule_id, r.end) for r in kept) == [(0, 3), (0, 8), (1, 9)]
    assert take_until(texts, base, "doc_id", lambda m: m["rule_id"] == 99).count() == 6


def test_combinations_and_quiet(spark):
    compiled = compile_rules(rules_table(spark, [
        rule("alpha", "QUIET", 0), rule("beta", (), 1), rule("gamma", (), 2),
        rule("0 & (1 | !2)", "COMBINATION", 10), rule("!0 & !1 & !2", "COMBINATION", 11),
        rule("0", ["COMBINATION", "QUIET"], 12)]))
    texts = docs(spark, "alpha beta", "alpha gamma", "alpha", "none", "")
    got = {(r.doc_id, r.rule_id) for r in combinations(texts, compiled, "doc_id").collect()}
    assert got == {(0, 10), (2, 10), (3, 11), (4, 11)}
    # quiet rules do not report: 2 is a text with only the quiet "alpha", but combination 10 holds there
    assert sorted(r.doc_id for r in any_match(texts, compiled, "doc_id").collect()) == [0, 1, 2, 3, 4]
    plain = compile_rules(rules_table(spark, [rule("alpha", "QUIET", 0), rule("beta", (), 1)]))
    assert sorted(r.doc_id for r in any_match(texts, plain, "doc_id").collect()) == [0]
    assert sorted((r.doc_id, r.rule_id) for r in hits(texts, plain, "doc_id").collect()) == [(0, 1)]
    rows = {(r.doc_id, r.rule_id) for r in scan(texts, compiled, "doc_id").collect()}
    assert rows == got | {(0, 1), (1, 2)}


def test_prefilter_and_groups(spark):
    rules = [rule("We counted ([0-9]+)", "CASELESS", 0, dialect="java"),
             rule("made of (oak|ash|elm)", (), 1, dialect="java"),
             rule(r"(\w)\1", (), 2, dialect="java")]
    compiled = compile_rules(rules_table(spark, rules))
    texts = docs(spark, "We counted 7 and then we COUNTed 27", "made of elm", "made of elm!", "nothing")
    wide = {(r.doc_id, r.rule_id): r.filterable for r in candidates(texts, compiled, "doc_id").collect()}
    assert wide[0, 0] and wide[1, 1] and all(wide[d, 2] is False for d in range(4))
    exact = {(r.doc_id, r.rule_id) for r in confirmed(texts, compiled, "doc_id").collect()}
    assert exact == {(0, 0), (1, 1), (2, 1)} and exact <= set(wide)
    full = {(r.doc_id, r.rule_id) for r in confirmed(texts, compiled, "doc_id", full_match=True).collect()}
    assert full == {(1, 1)}
    groups = capture_groups(texts, compiled, "doc_id").where("doc_id = 0 AND group_no = 1").collect()
    assert sorted(r.value for r in groups) == ["27", "7"]


def test_only_unfilterable_rules(spark):
    compiled = compile_rules(rules_table(spark, [rule(r"(\w)\1", (), 0, dialect="java")]))
    assert candidates(docs(spark, "ab", "aa"), compiled, "doc_id").count() == 2
    assert [r.doc_id for r in any_match(docs(spark, "ab", "aa"), compiled, "doc_id").collect()] == [1]


def test_lookup(spark):
    compiled = compile_rules(rules_table(spark, [rule("a", (), 10), rule("b", (), 20)]))
    ids = spark.createDataFrame([(10,), (20,), (99,)], "rule_id int")
    got = {r.rule_id: r.pattern for r in lookup_rules(ids, compiled).collect()}
    assert got == {10: "a", 20: "b", 99: None}


def test_rulesets_side_by_side(spark):
    rules = [rule("a", SOM, 500, ruleset="A"), rule("b", SOM, 501, ruleset="B"), rule("b", SOM, 500, ruleset="B"),
             rule("500", "COMBINATION", 9, ruleset="A")]
    compiled = compile_rules(rules_table(spark, rules))
    rows = scan(docs(spark, "a", "b"), compiled, "doc_id", with_ruleset=True).collect()
    assert sorted((r.doc_id, r.ruleset, r.rule_id) for r in rows) == [
        (0, "A", 9), (0, "A", 500), (1, "B", 500), (1, "B", 501)]
    found = lookup_rules(hits(docs(spark, "b"), compiled, "doc_id", with_ruleset=True), compiled).collect()
    assert {(r.ruleset, r.rule_id, r.pattern) for r in found} == {("B", 500, "b"), ("B", 501, "b")}


def test_single_and_counts(spark, base):
    texts = docs(spark, "lamp lamp7 lamp lamp9")
    one = {r.rule_id: (r.start, r.end) for r in single_matches(texts, base, "doc_id").collect()}
    assert one == {0: (0, 3), 1: (5, 9), 2: (16, 20)}
    counts = {r.rule_id: (r.n_matches, r.n_texts) for r in match_counts(texts, base).collect()}
    assert counts == {0: (4, 1), 1: (1, 1), 2: (1, 1)}
    assert matches_per_text(texts, base, "doc_id").first().matches[0].rule_id in {0, 1, 2}


def test_sinks(spark, base, tmp_path):
    found = scan(docs(spark, "lamp river", "river"), base, "doc_id")
    path = work_folder(spark, "matches")
    write_matches(found, path, partition_by=["rule_id"])
    assert spark.read.parquet(path).count() == 3
    target = str(tmp_path / "seen")

    def handler(rows):
        with open(target, "a") as f:
            f.writelines(f"{r.rule_id}\n" for r in rows)

    for_each_match(found, handler)
    assert sorted(open(target).read().split()) == ["0", "3", "3"]


def test_large_ruleset_takes_the_join(spark):
    rules = BASE + [rule("foo|barbaz", SOM, 5), rule(r"\d{3}", SOM, 6), rule("a.c", SOM, 7)]
    table = rules_table(spark, rules)
    small, large = compile_rules(table), compile_rules(table, max_rules=0)
    assert small.fits and not large.fits
    texts = docs(spark, "lamp7 foo barbaz foo", "山川 river 123", "aéc abc", "", "lamp", *["lamp foo 1234"] * 50)
    for op in (lambda c: hits(texts, c, "doc_id"), lambda c: scan(texts, c, "doc_id"),
               lambda c: any_match(texts, c, "doc_id"), lambda c: no_match(texts, c, "doc_id")):
        assert sorted(op(small).collect()) == sorted(op(large).collect())
    plan = hits(texts, large, "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan


def test_plan_is_one_narrow_pass(spark, base, tmp_path):
    path = str(tmp_path / "docs")
    docs(spark, "lamp", "river").withColumn("other", F.lit("x")).write.parquet(path)
    plan = scan(spark.read.parquet(path), base, "doc_id")._jdf.queryExecution().executedPlan().toString()
    for absent in ("Exchange", "Join", "Sort", "Python", "other"):
        assert absent not in plan
    assert plan.count("crc32") == 1, "the text is searched for anchors once"


def test_one_text_holds_most_matches(spark, base):
    texts = docs(spark, "lamp " * 20000, "river", "lamp")
    assert scan(texts, base, "doc_id").groupBy("doc_id").count().orderBy("doc_id").collect()[0]["count"] == 20000
    assert first_k(texts, base, "doc_id", 2).count() == 4


def test_compiled_rules_do_not_follow_their_source(spark, tmp_path):
    path = str(tmp_path / "rules")
    rules_table(spark, [rule("a", (), 3)]).write.parquet(path)
    compiled = compile_rules(spark.read.parquet(path))
    rules_table(spark, [rule("b", (), 3)]).write.mode("overwrite").parquet(path)
    found = hits(docs(spark, "a"), compiled, "doc_id")
    assert [(r.rule_id, r.pattern) for r in lookup_rules(found, compiled).collect()] == [(3, "a")]


def test_combination_events(spark):
    rules = [rule("sea", [SOM, "QUIET"], 0), rule("lake+", (), 1), rule("0 & !1", "COMBINATION", 10), rule("!0 | 1", "COMBINATION", 11),
             rule("0", ["COMBINATION", "QUIET"], 12)]
    docs = spark.createDataFrame([(1, "a sea, a lake and a sea"), (2, ""), (3, None), (4, "lakee sea")], "doc_id int, text string")
    want = [(1, 10, 4, True), (1, 10, 12, False), (1, 11, None, True), (1, 11, 4, False), (1, 11, 12, True), (2, 11, None, True),
            (4, 11, None, True)]
    for bounds in ({}, {"max_rules": 0}):
        compiled = compile_rules(rules_table(spark, rules), **bounds)
        got = combination_events(docs, compiled, "doc_id").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    plain = compile_rules(rules_table(spark, rules[:2]))
    assert combination_events(docs, plain, "doc_id").count() == 0
