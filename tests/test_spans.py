"""Golden spans: UTF-16 offsets, inclusive ends, unless a test says otherwise."""

import pytest
from pyspark.sql import functions as F

from sieveflow import byte_slice, compile_rules, hits, rule, rules_table, scan
from sieveflow.functions.offsets import byte_to_char, convert_offset

SOM = "SOM_LEFTMOST"
BASE = [
    rule("lamp", [SOM, "CASELESS"], 0), rule("lamp7", SOM, 1), rule("lamp9", SOM, 2),
    rule("river", SOM, 3), rule("山川", [SOM, "UTF8"], 4),
]
NUMBERS = "31415 27182 \U0001F33BSeven grey herons at☂\U00010348 noon, 16180 of them on one lake‡؟"


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")


def spans(spark, rules, text, **options):
    compiled = compile_rules(rules_table(spark, rules))
    rows = scan(texts(spark, text), compiled, "doc_id", **options).collect()
    return sorted((r.rule_id, r.start, r.end, r.matched) for r in rows)


CASES = [
    (BASE, "lamp lamp7 lamp lamp9", [
        (0, 0, 3, "lamp"), (0, 5, 8, "lamp"), (0, 11, 14, "lamp"), (0, 16, 19, "lamp"),
        (1, 5, 9, "lamp7"), (2, 16, 20, "lamp9")]),
    (BASE, "See 山川 river", [(3, 7, 11, "river"), (4, 4, 5, "山川")]),
    (BASE, "Nothing in this sentence is searched for.", []),
    (BASE, "", []),
    ([rule("La?mp", ["CASELESS", SOM], 100)], "Here was one Lamp lmp.",
     [(100, 13, 16, "Lamp"), (100, 18, 20, "lmp")]),
    ([rule("La?mp", ["CASELESS", SOM], 200), rule("was", ["CASELESS", SOM], 201)], "Here was one Lamp lmp.",
     [(200, 13, 16, "Lamp"), (200, 18, 20, "lmp"), (201, 5, 7, "was")]),
    ([rule("lamp", SOM, 17)], "98765 lamp shade", [(17, 6, 9, "lamp")]),
    ([rule("^first", (), 5)], "first second third", [(5, 0, 4, "")]),
    ([rule(r"\d{5}", [SOM, "UTF8"], 300)], NUMBERS,
     [(300, 0, 4, "31415"), (300, 6, 10, "27182"), (300, 44, 48, "16180")]),
    ([rule("Salut", ["UTF8", SOM], 700)], "\U0001F33B�Salut", [(700, 3, 7, "Salut")]),
    ([rule(".*", "ALLOWEMPTY", 101)], "", [(101, 0, 0, "")]),
    ([rule(".+", ["ALLOWEMPTY", SOM], 102)], "", []),
    ([rule("a+", SOM, 1)], "xaaab", [(1, 1, 1, "a"), (1, 1, 2, "aa"), (1, 1, 3, "aaa")]),
    ([rule("a+b?", SOM, 1)], "xaab", [(1, 1, 1, "a"), (1, 1, 2, "aa"), (1, 1, 3, "aab")]),
    ([rule("foo$", SOM, 1)], "foo\nfoo\n", [(1, 4, 6, "foo")]),
    ([rule("fo+$", [SOM, "MULTILINE"], 1)], "foo\nfoo\n", [(1, 0, 2, "foo"), (1, 4, 6, "foo")]),
    ([rule(r"\bab+\b", [SOM, "UTF8"], 1)], "éab abb cab", [(1, 1, 2, "ab"), (1, 4, 6, "abb")]),
    ([rule("a|", ["ALLOWEMPTY", SOM], 1)], "b", [(1, 0, 0, ""), (1, 1, 0, "")]),
    ([rule("aa", SOM, 1)], "aaaa", [(1, 0, 1, "aa"), (1, 1, 2, "aa"), (1, 2, 3, "aa")]),
    ([rule("a+", [SOM, "SINGLEMATCH"], 1)], "xaaab aa", [(1, 1, 1, "a")]),
    ([rule("a.c", [SOM, "UTF8"], 1), rule("a..c", SOM, 2), rule("a.c", SOM, 3)], "zéaéc",
     [(1, 2, 4, "aéc"), (2, 2, 4, "aéc")]),
    ([rule("x.", SOM, 2)], "éx\U0001F600x1", [(2, 1, 2, "x\U0001F600"), (2, 4, 5, "x1")]),
    ([rule("ab", SOM, 1)], "﷐ab﷐﷐ab", [(1, 1, 2, "ab"), (1, 5, 6, "ab")]),
]


def spans_of_all_cases(spark, **options):
    """All cases in one scan: each is a ruleset of its own and keeps the matches in its text."""
    rules = [{**r, "ruleset": str(i)} for i, (case, _, _) in enumerate(CASES) for r in case]
    compiled = compile_rules(rules_table(spark, rules))
    rows = scan(texts(spark, *[text for _, text, _ in CASES]), compiled, "doc_id", with_ruleset=True, **options)
    found = {}
    for r in rows.where("ruleset = cast(doc_id AS string)").collect():
        found.setdefault(r.doc_id, []).append((r.rule_id, r.start, r.end, r.matched))
    return {i: sorted(v) for i, v in found.items()}


@pytest.mark.parametrize("options", [{}, {"spread": True}])
def test_all_ends(spark, options):
    expected = {i: e for i, (_, _, e) in enumerate(CASES) if e}
    assert spans_of_all_cases(spark, **options) == expected


def test_units(spark):
    rules = [rule(r"\d{5}", [SOM, "UTF8"], 300)]
    last = {u: spans(spark, rules, NUMBERS, offset_unit=u)[2][1:3] for u in ("utf16", "codepoint", "byte")}
    assert last["utf16"] == (44, 48) and last["codepoint"] == (42, 46)
    start = len(NUMBERS[:42].encode())
    assert last["byte"] == (start, start + 4)


FIND_CASES = [
    ("a*", "baac", [(0, 0, ""), (1, 2, "aa"), (3, 2, ""), (4, 3, "")]),
    ("(?=(aa))", "aaa", [(0, 0, ""), (1, 0, "")]),
    ("a+?", "aaa", [(0, 0, "a"), (1, 1, "a"), (2, 2, "a")]),
    ("aa", "aaaaa", [(0, 1, "aa"), (2, 3, "aa")]),
    (r"(\w)\1", "xaabbc", [(1, 2, "aa"), (3, 4, "bb")]),
    ("x*", "\U0001F600", [(0, 0, ""), (2, 1, "")]),
    ("[^a]b", "\U0001F600b", [(0, 2, "\U0001F600b")]),
]


def test_find(spark):
    compiled = compile_rules(rules_table(spark, [rule(p, (), i, dialect="java") for i, (p, _, _) in enumerate(FIND_CASES)]))
    rows = scan(texts(spark, *[t for _, t, _ in FIND_CASES]), compiled, "doc_id").where("doc_id = rule_id").collect()
    for i, (_, _, expected) in enumerate(FIND_CASES):
        assert sorted((r.start, r.end, r.matched) for r in rows if r.doc_id == i) == expected


def test_a_text_with_thousands_of_matches(spark):
    text = "ab " * 5000
    rows = spans(spark, [rule("a", SOM, 1), rule("b+ ", SOM, 2), rule(r"\w\w", [SOM, "UTF8"], 3)], "é" + text)
    for i, width in ((1, 1), (2, 2), (3, 2)):
        at = 1 if i == 2 else 0
        assert [r[1:3] for r in rows if r[0] == i] == [
            (1 + 3 * k + at, 3 * k + at + width) for k in range(5000)]


def test_byte_scan(spark):
    compiled = compile_rules(rules_table(spark, BASE[3:]))
    blobs = texts(spark, "See 山川 river").select("doc_id", F.encode("text", "UTF-8").alias("data"))
    rows = scan(blobs, compiled, "doc_id", "data", byte_scan=True).collect()
    assert sorted((r.start, r.end) for r in rows) == [(4, 10), (11, 16)]
    part = blobs.select("doc_id", byte_slice(F.col("data"), 10, 6).alias("data"))
    rows = scan(part, compiled, "doc_id", "data", byte_scan=True).collect()
    assert [(r.start, r.end) for r in rows] == [(1, 6)]


def test_bytes_that_are_not_text(spark):
    compiled = compile_rules(rules_table(spark, [rule(r"\xff\x00+", SOM, 1), rule("ab", SOM, 2)]))
    blobs = spark.createDataFrame([(0, bytearray(b"\x80\xff\x00\x00ab\xe4"))], "doc_id int, data binary")
    rows = scan(blobs, compiled, "doc_id", "data", byte_scan=True).collect()
    assert sorted((r.rule_id, r.start, r.end) for r in rows) == [(1, 1, 3), (1, 1, 4), (2, 4, 6)]


@pytest.mark.parametrize("text, expected", [
    ("Plain, ascii!", list(range(13))),
    ("öüß", [0, 0, 1, 1, 2, 2]),
    ("かきく", [0, 0, 0, 1, 1, 1, 2, 2, 2]),
    ("\U00010348", [0, 0, 1, 1]),
    ("Ok 山\U00010348", [0, 1, 2, 3, 3, 3, 4, 4, 5, 5]),
])
def test_byte_to_char(spark, text, expected):
    df = texts(spark, text).select("text", F.explode(F.sequence(F.lit(0), F.lit(len(expected) - 1))).alias("b"))
    rows = df.select("b", byte_to_char(F.col("text"), F.col("b")).alias("c")).orderBy("b").collect()
    assert [r.c for r in rows] == expected


def test_convert_offset(spark):
    row = texts(spark, NUMBERS).select(
        convert_offset(F.col("text"), F.lit(42), "utf16").alias("u"),
        convert_offset(F.col("text"), F.lit(42), "byte").alias("b")).first()
    assert (row.u, row.b) == (44, len(NUMBERS[:42].encode()))


def test_anchored_many_rules(spark):
    parts = [f"^node{i:03d}/queue/items-(live|spare)-.*/[0-9]+$" for i in range(213)]
    flags = ["SINGLEMATCH", "ALLOWEMPTY", "UTF8", "PREFILTER"]
    compiled = compile_rules(rules_table(spark, [rule(p, flags) for p in parts]))
    rows = hits(texts(spark, "node077/queue/items-live-north-x/0"), compiled, "doc_id").collect()
    assert [r.rule_id for r in rows] == [77]


def test_sparse_ids(spark):
    compiled = compile_rules(rules_table(spark, [
        rule("^.*LANTERN.*OX.*$", "CASELESS", 20044710), rule("^.*KITES.*SKY.*$", "CASELESS", 20044705)]))
    docs = texts(spark, "LANTERN SHOP AT UPPER HARBOUR FOX")
    assert [r.rule_id for r in hits(docs, compiled, "doc_id").collect()] == [20044710]
    assert [(r.start, r.end) for r in scan(docs, compiled, "doc_id").collect()] == [(0, 32)]


def test_is_empty(spark):
    compiled = compile_rules(rules_table(spark, [rule("a|", ["ALLOWEMPTY", SOM], 1)]))
    rows = scan(texts(spark, "a"), compiled, "doc_id", with_is_empty=True).collect()
    assert sorted((r.start, r.end, r.is_empty) for r in rows) == [(0, 0, False), (0, 0, True)]
