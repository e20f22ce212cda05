"""Random rules and texts against brute force."""

import random
import re

from sieveflow import candidates, choose_factors, compile_rules, hits, rule, rules_table, scan
from sieveflow.schemas import JAVA

ATOMS = ["a", "b", "c", "ab", "bca", "abc", "k", "is", r"\.", "[ab]", "[^a]", r"\w", r"\d", "x", "cab"]


def pattern(rng: random.Random, depth: int = 0) -> str:
    """A regex whose meaning does not depend on what surrounds the match."""
    parts = []
    for _ in range(rng.randint(1, 4)):
        if depth < 2 and rng.random() < 0.3:
            atom = f"(?:{pattern(rng, depth + 1)})"
        else:
            atom = rng.choice(ATOMS)
        if rng.random() < 0.25:
            atom = atom if atom.startswith(("(", "[", "\\")) or len(atom) == 1 else f"(?:{atom})"
            atom += rng.choice(["?", "*", "+", "{2}", "{1,3}", "+?", "{0,2}"])
        parts.append(atom)
    text = "".join(parts)
    return f"{text}|{pattern(rng, depth + 1)}" if rng.random() < (0.25 if depth < 2 else 0) else text


def sample(seed: int, n_rules: int, n_texts: int):
    rng = random.Random(seed)
    patterns = []
    while len(patterns) < n_rules:
        p = pattern(rng)
        if not re.fullmatch(p, ""):
            patterns.append(p)
    texts = ["".join(rng.choice("aabbccabkisxX. 12é\n") for _ in range(rng.randint(0, 24))) for _ in range(n_texts)]
    return patterns, texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(8)


def test_spans_against_every_start_and_end(spark):
    patterns, texts = sample(7, 120, 25)
    compiled = compile_rules(rules_table(spark, [rule(p, ["SOM_LEFTMOST", "UTF8"], i) for i, p in enumerate(patterns)]))
    got = {(r.doc_id, r.rule_id, r.end): r.start for r in scan(frame(spark, texts), compiled, "doc_id").collect()}
    expected = {}
    for i, p in enumerate(patterns):
        regex = re.compile(p, re.ASCII)
        for d, t in enumerate(texts):
            for e in range(1, len(t) + 1):
                starts = [s for s in range(e) if regex.fullmatch(t, s, e)]
                if starts:
                    expected[d, i, e - 1] = starts[0]
    assert got == expected
    assert len(expected) > 1000


def test_candidates_hold_every_hit(spark):
    patterns, texts = sample(11, 200, 60)
    texts += [t.upper() for t in texts[:30]] + ["Kiſs is", "IS KI İs", "ΣAB abΣ"]
    rules = [rule(p, f, 3 * i + j, dialect=d) for i, p in enumerate(patterns) for j, (f, d) in enumerate(
        [((), "direct"), (("CASELESS", "UTF8"), "direct"), (("CASELESS", "UNICODE_CASE"), JAVA)])]
    compiled = compile_rules(rules_table(spark, rules))
    docs = frame(spark, texts)
    pairs = {(r.doc_id, r.rule_id) for r in candidates(docs, compiled, "doc_id").collect()}
    found = {(r.doc_id, r.rule_id) for r in hits(docs, compiled, "doc_id").collect()}
    rx = spark.createDataFrame([(r["rule_id"], r["rx"], r["bytes"]) for r in compiled.rows], "rule_id int, rx string, b boolean")
    views = docs.selectExpr("doc_id", "text", "decode(encode(text, 'UTF-8'), 'ISO-8859-1') AS raw")
    brute = {(r.doc_id, r.rule_id) for r in views.crossJoin(rx).where("rlike(IF(b, raw, text), rx)").collect()}
    assert found == brute
    assert brute <= pairs
    assert any(r["literals"] for r in compiled.rows)


def stepwise_pattern(rng: random.Random) -> str:
    """Blocks and unbounded repeats, in any order."""
    atoms = ["a", "b", "c", "ab", r"\.", "[ab]", "[^a]", r"\w", r"\d", ".", "é", r"\s"]
    return "".join(rng.choice(atoms) if rng.random() < 0.5 else rng.choice([a for a in atoms if a != "ab"]) + rng.choice(
        ["*", "+", "{2,}", "+?", "*?", "{2}"]) for _ in range(rng.randint(1, 5)))


def test_steps_against_every_start_and_end(spark):
    rng = random.Random(23)
    patterns = list(dict.fromkeys(["^.*a.*b.*$", "a.*x", r"\bab*\b", ".*", "a*b*c*", *(stepwise_pattern(rng) for _ in range(110))]))
    texts = ["", "\n\n"] + ["".join(rng.choice("aabbccabx. 12é\n") for _ in range(rng.randint(0, 22))) for _ in range(30)]
    compiled = compile_rules(rules_table(spark, [rule(p, ["SOM_LEFTMOST", "UTF8", "ALLOWEMPTY"], i) for i, p in enumerate(patterns)]))
    assert sum(r["kind"] == "steps" for r in compiled.rows) > 80
    for unit, size in (("codepoint", len), ("byte", lambda t: len(t.encode()))):
        got = {(r.doc_id, r.rule_id, r.end, r.is_empty): (r.start, r.matched) for r in scan(
            frame(spark, texts), compiled, "doc_id", offset_unit=unit, with_is_empty=True).collect()}
        expected = {}
        for i, p in enumerate(patterns):
            regex = re.compile(p, re.ASCII)
            for d, t in enumerate(texts):
                for e in range(len(t) + 1):
                    starts = [s for s in range(e + 1) if regex.fullmatch(t, s, e) and ("$" not in p or t[e:] in ("", "\n")) and (
                        not p.startswith("^") or s == 0) and (r"\b" not in p or (edge(t, s) and edge(t, e)))]
                    if starts:
                        s = starts[0]
                        expected[d, i, max(size(t[:e]) - 1, 0), s == e] = (size(t[:s]), t[s:e])
        assert got == expected
        assert len(expected) > 5000


def edge(text: str, at: int) -> bool:
    def word(i):
        return 0 <= i < len(text) and re.match(r"\w", text[i], re.ASCII) is not None
    return word(at - 1) != word(at)


def test_long_texts_in_about_linear_time(spark):
    compiled = compile_rules(rules_table(spark, [rule("^.*A.*B.*$", (), 0), rule("a.*x", (), 1), rule("[ab]+", (), 2)]))
    text = ("a b A lorem x ipsum B dolor\n" * 20_000)[:-1]
    df = spark.createDataFrame([(1, text), (2, text.replace("\n", "_"))], "doc_id int, text string")
    counts = {(r.doc_id, r.rule_id): r["count"] for r in scan(df, compiled, "doc_id").groupBy("doc_id", "rule_id").count().collect()}
    assert counts == {(1, 1): 20_000, (1, 2): 40_000, (2, 0): 1, (2, 1): 20_000, (2, 2): 40_000}


def test_chains_against_every_start_and_end(spark):
    """Repeats of one character with blocks of it between them are found in one pass over each run."""
    rng = random.Random(29)
    flags = [[], ["MULTILINE"], ["DOTALL"], ["MULTILINE", "DOTALL"], ["CASELESS"]]
    patterns = ["a.*b", "ab.*a", "^.*a.*b.*$", "^.+a", "aa.*a", "a.{2,}b.*", "^.*ab.+$", "a.*b[ab]*x", r"a\w*b\w*\.", "a[^b]*x", "ab[ab]*a", "a.*$", "a.*a.*\\n"]
    cases = [(i, p, f) for i, (p, f) in enumerate((p, f) for p in patterns for f in flags)]
    texts = ["", "\n", "a\ufdd0b\ufdd0", "\ufdd0\ufdd0a.b\nab"] + ["".join(rng.choice("aaabbbAx.\n😀") for _ in range(rng.randint(0, 16))) for _ in range(40)]
    compiled = compile_rules(rules_table(spark, [rule(p, ["SOM_LEFTMOST", "UTF8", *f], i) for i, p, f in cases]))
    assert sum(r["steps"] is not None and r["steps"][0].lo is not None for r in compiled.rows) > 50
    assert sum(r["test"] is not None for r in compiled.rows) > 30
    got = {(r.doc_id, r.rule_id, r.end): (r.start, r.matched) for r in scan(frame(spark, texts), compiled, "doc_id", offset_unit="codepoint").collect()}
    expected = {}
    for i, p, f in cases:
        regex = re.compile(p, re.ASCII | sum(getattr(re, {"CASELESS": "IGNORECASE"}.get(n, n)) for n in f))
        for d, t in enumerate(texts):
            for e in range(1, len(t) + 1):
                closed = t[e:] in ("", "\n") or ("MULTILINE" in f and t[e] == "\n") or "$" not in p
                starts = [s for s in range(e) if regex.fullmatch(t, s, e)] if closed else []
                if starts:
                    expected[d, i, e - 1] = (starts[0], t[starts[0]: e])
    assert got == expected
    assert len(expected) > 1500
    assert {(r.doc_id, r.rule_id) for r in hits(frame(spark, texts), compiled, "doc_id").collect()} == {k[:2] for k in expected}


def test_a_line_in_which_nothing_follows(spark):
    """A chain that fails is given up for its whole line: its regex would go on to the line's end from each place (8e10 characters)."""
    compiled = compile_rules(rules_table(spark, [rule("a.*x", ["SOM_LEFTMOST"], 0), rule("^.*a.*b.*$", ["MULTILINE"], 1)]))
    df = spark.createDataFrame([(1, "a" * 400_000), (2, "a" * 400_000 + "\nax")], "doc_id int, text string")
    assert [(r.doc_id, r.rule_id, r.start, r.end) for r in scan(df, compiled, "doc_id").collect()] == [(2, 0, 400_001, 400_002)]


def test_chosen_factors_keep_every_hit(spark):
    rng = random.Random(31)
    words = ["lorem", "ipsum", "dolor", "the", "rare", "sit"]
    patterns = [r".*".join(rng.sample(words, rng.randint(1, 3))) for _ in range(25)] + ["(?:lorem|sit).*rare", "the|rare.*sit", "rare(?:.*sit)?", "lorem[a-z]{3,}ipsum+"]
    rules = [rule(p, ["CASELESS", "DOTALL"], i, dialect=d) for i, (p, d) in enumerate((p, d) for p in patterns for d in ("direct", JAVA))]
    texts = [" ".join(rng.choice(words[:4] * 4 + words).upper() if rng.random() < 0.2 else rng.choice(words[:4] * 4 + words)
                      for _ in range(rng.randrange(8))) for _ in range(150)]
    docs = frame(spark, texts)
    for bounds in ({}, {"max_rules": 0}):
        compiled = compile_rules(rules_table(spark, rules), **bounds)
        chosen = choose_factors(compiled, docs)
        before, after = ({(r.doc_id, r.rule_id) for r in candidates(docs, c, "doc_id").collect()} for c in (compiled, chosen))
        found = {(r.doc_id, r.rule_id) for r in hits(docs, chosen, "doc_id").collect()}
        assert found == {(d, r["rule_id"]) for d, t in enumerate(texts) for r in rules if re.search(r["pattern"], t, re.I | re.S)}
        assert found <= after == before
        assert len(after) < 1.6 * len(found)
        if not bounds:
            assert sum(a["literals"] != b["literals"] for a, b in zip(compiled.rows, chosen.rows)) > 5
            assert "Join" not in hits(docs, chosen, "doc_id")._jdf.queryExecution().toString()
