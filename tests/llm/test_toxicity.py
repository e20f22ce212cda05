import random
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm import toxicity
from sieveflow.llm.queries import op10_toxicity
from sieveflow.llm.toxicity import (
    PRIOR, STEM, Automaton, Model, Scorer, _logistic, drop_toxic, fit, lexicon, lexicon_and_support, meant_words, scores,
)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton():
    terms = ["trash", "clown", "idiot", "worthless", "scum"]
    automaton = Automaton([(t, False) for t in terms] + [("vequ", True)])
    words = set(terms) | {"vequite", "vequ", "veq"}
    for t in terms:
        for i in range(len(t) + 1):
            words |= {t[:i] + t[i + 1:], t[:i] + "x" + t[i:], t[:i] + "0" + t[i + 1:], t[:i] + "xy" + t[i:]}
    for w in words:
        d = min(distance(w, t) if len(t) >= 5 else (0 if w == t else 9) for t in terms)
        want = 0 if w.startswith("vequ") or d == 0 else 1 if d == 1 and any(
            distance(w, t) == 1 and len(t) >= 5 and w[:1] == t[0] for t in terms) else -1
        if not (d == 1 and want == -1):  # a first letter that differs is left open
            assert automaton.match(w) == want, w


def test_context():
    scorer = Scorer([("idiot", False)])
    plain, quoted, reported = (scorer.features(t) for t in (
        "well you are an idiot my friend", 'he wrote "what an idiot he is" in a letter', "a man said idiot and left"))
    assert plain[1] > 0 and quoted[1] == 0 and quoted[2] > 0 and reported[2] > 0
    assert scorer.features("an idi0t came")[1] > 0 and scorer.features("") == scorer.features("fine words") == (0.0,) * 5


def test_fit_does_not_diverge():
    rng = np.random.default_rng(0)
    y = (rng.random(5000) < 0.1).astype(float)
    x = np.column_stack((np.ones(5000), *(y * rng.random(5000) * 9 for _ in range(5))))
    w = _logistic(x, y, PRIOR)
    p = 1 / (1 + np.exp(-x @ w))
    assert np.isfinite(w).all() and ((p > 0.7) == (y == 1)).mean() > 0.99


def test_held_out_accuracy(spark):
    """On the larger table: the smallest has too few labels for a lexicon."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = op10_toxicity(spark, sf_dir).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    out = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in out) / len(out) > 0.9 and not any(p for a, p in out if a == 0)


def test_odd_rows(spark):
    docs = odd_docs(spark, clash=True)
    model = Model([("fox", False)], PRIOR)
    got = scores(docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ODD) and all(0 <= r.score <= 1 for r in got)
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in ODD if "fox" not in (r[1] or ""))


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 1), (1, 0)], [(4, 0), (5, 0)]])
def test_hardly_any_labels(spark, labels):
    df = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = scores(odd_docs(spark), fit(odd_docs(spark), df)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit(empty_docs(spark), labels)
    assert rows_of(scores(empty_docs(spark), model)) == [] and rows_of(drop_toxic(empty_docs(spark), model)) == []


@pytest.mark.parametrize("stems", [[], ["tras"], ["trash"], ["scum", "idio"]])
def test_every_word_one_edit_away(stems):
    """At every place, the first letter included, whether or not a stem begins the term."""
    terms = ["trash", "trashy", "clown", "idiot", "worthless", "scum", "scumbag"]
    automaton = Automaton([(t, False) for t in terms] + [(s, True) for s in stems])
    words = {"1diot", "$tupid", "xidiot", "tr4sh", "scun", "tr4s"}
    for t in terms:
        for i in range(len(t) + 1):
            words |= {t[:i] + t[i + 1:], *(t[:i] + c + t[i + k:] for c in "x0ts$" for k in (0, 1)), t[:i] + "xy" + t[i:]}
    for w in words:
        whole = min(distance(w, t) if len(t) >= 5 else (0 if w == t else 9) for t in terms)
        want = 0 if whole == 0 or any(w.startswith(s) for s in stems) else 1 if whole == 1 else -1
        assert automaton.match(w) == want, w


def test_lexicon_keeps_words_under_a_stem(spark):
    rows = [(f"{b} trash {b} trashy {b} trashes walk", 1) for b in "one two three four five six".split()]
    terms = [(t, s) for t, s, _ in lexicon(spark.createDataFrame(rows, "text string, toxic int"))]
    assert ("trash", False) in terms and ("tras", True) in terms
    assert Automaton(terms).match("tr4sh") == Automaton(terms).match("1rash") == 1


def test_lexicon_does_not_move_with_size_or_copies(spark):
    befores = "one two three four five six".split()
    rows = [(f"{b} grubnak left", 1) for b in befores]
    rows += [("many copies of a bad text", 1)] * 4000           # more toxic texts, and copies of one
    rows += [('he wrote "grubnak" in a letter', 0)] * 3000     # a clean text that quotes it, copied
    rows += [(f"{b} harmless left", 1) for b in befores] + [(f"{b} harmless left", 0) for b in befores]
    got = {t: n for t, stem, n in lexicon(spark.createDataFrame(rows, "text string, toxic int")) if not stem}
    assert got == {"grubnak": 6}


def test_too_many_terms_need_more_contexts(spark, monkeypatch):
    """60,000 words are found in toxic texts only, a thousand of them in more contexts: these are the lexicon."""
    rows = [(" ".join(f"b{k} w{i}" for i in range(j, j + 500)), 1) for j in range(0, 60_000, 500) for k in range(5)]
    rows += [(" ".join(f"c{k} w{i}" for i in range(j, j + 500)), 1) for j in range(0, 1000, 500) for k in range(3)]
    terms, support = lexicon_and_support(spark.createDataFrame(rows, "text string, toxic int").repartition(8))
    assert support == 6 and len([t for t, stem, _ in terms if not stem]) == 1000 and {n for _, stem, n in terms if not stem} == {8}
    monkeypatch.setattr(toxicity, "MAX_TERMS", 1)
    rows = [(f"{b} grubnak {b} other", 1) for b in "one two three four five six".split()] + [("seven grubnak", 1)]
    assert lexicon_and_support(spark.createDataFrame(rows, "text string, toxic int")) == ([("grubnak", False, 7)], 7)


def plain_lexicon(rows):
    contexts = {(w, before, toxic) for text, toxic in rows for w, before in meant_words(text).items()}
    bad, clean = (Counter(w for w, _, toxic in contexts if toxic == k) for k in (1, 0))
    good = lambda b, c: b >= 5 and b >= 0.95 * (b + c)
    found = {(w, False, n) for w, n in bad.items() if good(n, clean[w])}
    for k in STEM:
        for s in {w[:k] for w in bad if len(w) >= k or len(w) >= 4}:
            under = [w for w in bad if w[:k] == s]
            b, c = (sum(n for w, n in count.items() if w[:k] == s) for count in (bad, clean))
            if len(s) >= 4 and len(under) >= 3 and good(b, c):
                found.add((s, True, b))
    stems = {t for t, stem, _ in found if stem}
    return {(t, stem, n) for t, stem, n in found if not (stem and any(t[:k] in stems for k in STEM if k < len(t)))}


@pytest.mark.parametrize("seed", [1, 2])
def test_lexicon_as_by_all_contexts(spark, monkeypatch, seed):
    """Clean texts are only asked about words that matter, and only as long as they do."""
    monkeypatch.setattr(toxicity, "REMEMBERED", 20)
    rng = random.Random(seed)
    words = ["trash", "trashy", "trashes", "scum", "vile", "vilely", "fine", "the", "a", "thing", "things", "thin", "word"]
    rows = []
    for _ in range(600):
        toxic = int(rng.random() < 0.4)
        pool = words if toxic else words[6:] + (["trash"] if rng.random() < 0.03 else []) + (["vilely"] if rng.random() < 0.1 else [])
        rows.append((" ".join(rng.choice([rng.choice(pool), f"x{rng.randrange(60)}"]) for _ in range(12)), toxic))
    got = lexicon(spark.createDataFrame(rows, "text string, toxic int").repartition(6))
    assert set(got) == plain_lexicon(rows) and len(got) > 3
