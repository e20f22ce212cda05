import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sieveflow import (
    RuleError, compile_rules, hits, load_compiled, load_rules, rule, rule_count, rules_from_df, rules_from_regex, rules_table,
    ruleset_diff, same_rules, save_compiled, save_rules, scan, set_apart_slow, validate_rules, with_flag_bits, work_folder,
)
from sieveflow.operators.validate import slow_rule_hint
from sieveflow.plans import compiled as compiled_module

SOM = "SOM_LEFTMOST"


def docs(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


VALIDITY = [
    ("La?mp", (), True), (r"lamp\1", (), False), ("lamp(", (), False), ("a++", ["UTF8"], False),
    ("a)(b", (), False), ("(?=a)b", (), False), ("(?<!a)b", (), False), ("(?>a)b", (), False),
    (r"a\Kb", (), False), ("(*UTF8)a", (), False), (r"(?<n>a)\k<n>", (), False), ("a{2}+", (), False),
    (".*", (), False), (".*", ["ALLOWEMPTY"], True), ("a|", ["ALLOWEMPTY"], True), ("a|", (), False),
    ("[[:alpha:]]+[a[b]", (), True), ("(?i)a[^]]b", (), True), (r"a\++", (), True), ("[a++]b", (), True),
    ("0 & (1 | !2)", ["COMBINATION"], True), ("0 & (1", ["COMBINATION"], False), ("0 1", ["COMBINATION"], False),
    ("!(0|1)&!!2", ["COMBINATION"], True), (r"x\1y(?=z)", ["PREFILTER"], True),
]


def test_validation(spark):
    rows = validate_rules(rules_table(spark, [rule(p, f, i) for i, (p, f, _) in enumerate(VALIDITY)])).collect()
    got = {r.rule_id: (r.is_valid, r.error) for r in rows}
    for i, (p, _, valid) in enumerate(VALIDITY):
        assert got[i][0] == valid, (p, got[i])
        assert (got[i][1] is None) == valid


def test_compile_names_the_bad_rule(spark):
    rules = rules_table(spark, [rule("ok", (), 1), rule("lamp(", (), 2)])
    with pytest.raises(RuleError) as e:
        compile_rules(rules)
    assert [f[:2] for f in e.value.failed_rules] == [(2, "lamp(")]
    assert [r["rule_id"] for r in compile_rules(rules, strict=False).rows] == [1]


@pytest.mark.parametrize("rules, message", [
    ([], "empty"),
    ([rule("a", (), 1), rule("b", (), 1)], "duplicate"),
    ([rule("a", (), 1), rule("b")], "either all"),
])
def test_ruleset_checks(spark, rules, message):
    with pytest.raises(ValueError, match=message):
        compile_rules(rules_table(spark, rules))


def test_negative_and_null_arguments(spark):
    for make in (lambda: rule("a", (), -1), lambda: rule(None), lambda: rule("a", None), lambda: rule("a", [None]),
                 lambda: rule("a", "LOUD")):
        with pytest.raises(ValueError):
            make()
    negative = rules_from_df(spark.createDataFrame([(-1, "a")], "rule_id int, pattern string"))
    with pytest.raises(ValueError, match="negative"):
        compile_rules(negative)


def test_positional_ids(spark):
    compiled = compile_rules(rules_table(spark, [rule("lamp", "CASELESS"), "[0-9]+"]))
    rows = hits(docs(spark, "LAMP 1"), compiled, "doc_id").collect()
    assert sorted(r.rule_id for r in rows) == [0, 1]


def test_unknown_combination_operand(spark):
    with pytest.raises(RuleError, match="unknown rules"):
        compile_rules(rules_table(spark, [rule("a", (), 0), rule("0 & 7", "COMBINATION", 1)]))


def test_save_and_load(spark):
    rules = rules_table(spark, [rule(r"Shop\d+", ["CASELESS", SOM], 100), rule(r"\d{2}:\d{2}:\d{2,4}0", (), 200)])
    path = work_folder(spark, "rules")
    save_rules(rules, path)
    loaded = load_rules(spark, path)
    assert same_rules(rules, loaded) and rule_count(loaded) == 2
    text = docs(spark, "Then Shop1 at 11:22:3340 Shop2 end")
    both = [sorted(scan(text, compile_rules(r), "doc_id").collect()) for r in (rules, loaded)]
    assert both[0] == both[1]
    assert [(r.rule_id, r.start, r.end) for r in both[0]] == [(100, 5, 9), (100, 25, 29), (200, 0, 23)]


def test_saved_rules_keep_missing_ids(spark):
    path = work_folder(spark, "rules")
    save_rules(rules_table(spark, ["a", "b"]), path)
    assert [r.rule_id for r in load_rules(spark, path).collect()] == [None, None]


def test_equality_and_diff(spark):
    a = rules_table(spark, [rule("lamp", ["CASELESS", SOM], 1), rule("x", (), 2), rule("y", (), 3)])
    b = rules_table(spark, [rule("x", "NO_FLAG", 2), rule("lamp", [SOM, "CASELESS"], 1), rule("y", (), 3)])
    c = rules_table(spark, [rule("lamp", [SOM], 1), rule("y", (), 3), rule("z", (), 4)])
    assert same_rules(a, b) and not same_rules(a, c)
    got = sorted((r.rule_id, r.change) for r in ruleset_diff(a, c).collect())
    assert got == [(1, "changed"), (2, "removed"), (4, "added")]


def test_flag_bits(spark):
    rows = with_flag_bits(rules_table(spark, [rule("a", ["CASELESS", "UTF8", SOM]), rule("b")])).collect()
    assert [r.flag_bits for r in rows] == [1 + 32 + 256, 0]


JAVA_RULES = [
    ("We counted ([0-9]+)", 0), ("We counted ([0-9]+)", 2), ("^made of (oak|ash|elm)$", 0),
    ("^made of (oak|ash|elm)$", 8), ("upper.lower", 0), ("upper.lower", 32), ("left.RIGHT", 34),
]


def test_java_flag_matrix(spark):
    df = spark.createDataFrame([(i, p, f) for i, (p, f) in enumerate(JAVA_RULES)], "id int, pattern string, bits int")
    compiled = compile_rules(rules_from_regex(df, "pattern", "bits", "id"))
    texts = docs(spark, "wE couNTed 17", "We counted 17", "A chair\nmade of ash", "upper\nlower",
                 "left\nrighT")
    got = {}
    for r in hits(texts, compiled, "doc_id").collect():
        got.setdefault(r.doc_id, set()).add(r.rule_id)
    assert got == {0: {1}, 1: {0, 1}, 2: {3}, 3: {5}, 4: {6}}


LITERALS = [
    ("food(bar|baz)?qux", ["food"]), ("foo|bar", ["bar", "foo"]), ("la?mp", None), ("x(?:abc)+d", ["xabc"]),
    ("(?:password|secret)\\s*=", ["password", "secret"]), ("foo|ba", None), ("(?:foo|bar)?x", None),
    ("Licen[sc]e\\.txt", ["e.txt"]), ("a(?:foo|bar)*", None), ("((?:foo|bar)|ba)", None),
    (r"\Qa.b\E", None), ("(?x)foo bar", None), ("abc{0}def", ["def"]), ("abcd{2,}", ["abcd"]), ("ab(c)de", ["abcde"]),
]


def test_required_literals(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(LITERALS)], "i int, p string")
    from sieveflow.functions.syntax import required_literals, tokens
    flags = F.array().cast("array<string>")
    rows = df.select("i", required_literals(tokens(F.col("p")), F.col("p"), flags, F.lit("direct")).alias("w")).collect()
    for r in rows:
        assert (sorted(r.w) if r.w else None) == LITERALS[r.i][1], LITERALS[r.i]


def test_slow_rule_hint(spark):
    df = spark.createDataFrame([("(a+)+",), ("(ab)+",)], "p string")
    assert [r.s for r in df.select(slow_rule_hint(F.col("p")).alias("s")).collect()] == [True, False]


def test_reload_without_deriving(spark, monkeypatch):
    rules = rules_table(spark, [rule("a+b", ["SOM_LEFTMOST"], 0), rule("x(y)?", (), 1, dialect="java"), rule("0 & !1", "COMBINATION", 2), rule("é.*z", ["UTF8"], 3)])
    path = work_folder(spark, "compiled")
    first = save_compiled(rules, path)
    with monkeypatch.context() as m:
        m.setattr(compiled_module, "derive", None)
        again = load_compiled(spark, path)
    plain = lambda c: [sorted(map(str, x)) for x in (c.rows, c.combinations, c.table.select("pattern", "rx").collect())]
    assert plain(first) == plain(again) and first.n_rules == again.n_rules == 4
    # other rules, or another library: compiled anew
    save_rules(rules.where("rule_id < 2"), f"{path}/rules", "overwrite")
    assert load_compiled(spark, path).n_rules == 2
    save_compiled(rules, path, "overwrite")
    monkeypatch.setattr(compiled_module, "library_digest", lambda: "other")
    calls = []
    monkeypatch.setattr(compiled_module, "derive", lambda r, f=compiled_module.derive: calls.append(1) or f(r))
    assert load_compiled(spark, path).n_rules == 4 and calls


def test_reload_of_many_rules_is_much_faster(spark):
    words = spark.range(10_000).selectExpr("CAST(id AS INT) AS rule_id", "concat('(?:word', id, '|other', id, ')[a-z]+x{2,5}') AS pattern")
    path = work_folder(spark, "compiled")
    save_compiled(rules_from_df(words), path)
    start = time.perf_counter()
    compile_rules(load_rules(spark, f"{path}/rules"))
    compiled_in = time.perf_counter() - start
    load_compiled(spark, path)
    start = time.perf_counter()
    assert load_compiled(spark, path).n_rules == 10_000
    print("compiled", compiled_in, "loaded", time.perf_counter() - start)
    assert time.perf_counter() - start < compiled_in / 2


def test_nested_repeats_become_one(spark):
    """The same matches as by definition, and no exponential time."""
    shapes = ["(a+)+", "(?:a+)*b", "(?:[ab]*)+c", "(?:a*)*", "x(?:\\w+)+", "(?:.+)+b", "(a+)+(b+)+"]
    rules = rules_table(spark, [rule(p, ["SOM_LEFTMOST", "ALLOWEMPTY", "UTF8"], i) for i, p in enumerate(shapes)])
    compiled = compile_rules(rules)
    rng = random.Random(8)
    texts = ["".join(rng.choice("aabcx ") for _ in range(rng.randrange(10))) for _ in range(40)]
    got = {(r.doc_id, r.rule_id, r.end, r.is_empty): r.start for r in scan(docs(spark, *texts), compiled, "doc_id", with_is_empty=True).collect()}
    want = {}
    for i, p in enumerate(shapes):
        for d, t in enumerate(texts):
            for e in range(len(t) + 1):
                s = next((s for s in range(e + 1) if re.fullmatch(p, t[s:e])), None)
                if s is not None:
                    want[d, i, max(e - 1, 0), s == e] = s
    assert got == want
    hard = docs(spark, "a" * 40 + "!", "ab" * 20 + "!")
    slow = compile_rules(rules_table(spark, [rule("(a+)+c", (), 0), rule("(?:[ab]*)*c", (), 1), rule("(a+)+$", (), 2, dialect="java")]))
    hits(hard, slow, "doc_id").collect()
    start = time.perf_counter()
    assert hits(hard, slow, "doc_id").count() == 0 and time.perf_counter() - start < 2


def test_slow_rules_are_set_apart(spark):
    rules = rules_table(spark, [rule(p, (), i, dialect="java") for i, p in enumerate(["(a+)+", "(ab+)+c", "(?:a*)*x", "ab", "(?:a+b*)*"])] + [
        rule("(ab+)+c", ["LITERAL"], 9, dialect="java")])
    rest, slow = set_apart_slow(rules)
    assert sorted(r.rule_id for r in rest.collect()) == [0, 2, 3, 9]
    assert sorted((r.rule_id, r.reason) for r in slow.collect()) == [(1, "a repeated group ends in a repeat"), (4, "a repeated group ends in a repeat")]
