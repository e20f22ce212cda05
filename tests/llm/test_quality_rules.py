import re
from collections import Counter

from helpers import ODD, empty_docs, odd_docs, rows_of
from sieveflow.llm.queries import op9_quality_rules
from sieveflow.llm.quality_rules import quality

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    words = re.findall(WORD, text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    lines = [l for l in (text or "").split("\n") if re.search(WORD, l)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def base(rows):
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)


def test_base_counts(spark):
    rows = ODD + [(40, "a b c d e f\na b c d e f\n \n\n# $ | <x>\n# $ | <x>", "en", "a", 1), (41, "a b c d e " * 2 + "z y x w v u", "en", "a", 1)]
    got = quality(odd_docs(spark, True, rows)).collect()
    assert base(got) == Counter((r[0], *plain(r[1])) for r in rows)


def test_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = op9_quality_rules(spark, sf_dir).collect()
    assert base(got) == Counter((d.doc_id, *plain(d.text)) for d in docs)
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert all(r.kept or r.base_failed for r in got if r.doc_id in good)


def test_divergence(spark):
    words = "the of and a to in is house tree river walks green stone light under".split()
    rows = [(i, " ".join(words[(i * 7 + k * k + k // 3) % len(words)] + ("" if k % 2 else str(k)) for k in range(90)), "en", "a", 1) for i in range(40)]
    shout = " ".join(f"{chr(65 + k % 26)}{chr(65 + k // 26)}{k * 7 % 13}!!#" for k in range(90))
    rows += [(900, shout, "en", "a", 1), (901, shout, None, "a", 1)]
    got = {r.doc_id: r for r in quality(odd_docs(spark, rows=rows)).collect()}
    assert all(got[i].kept for i in range(40) if not got[i].base_failed)
    assert not got[900].kept and not got[900].base_failed and 0.3 < got[900].class_distance <= 1
    assert got[901].kept and got[901].class_distance < 1e-6  # the only one of its language


def test_empty(spark):
    assert rows_of(quality(empty_docs(spark))) == []


def test_texts_without_common_words_are_refused(spark):
    """Gibberish, and another language under this lang; their characters are as usual."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    long = [r for r in docs.collect() if r.doc_id in good and len(r.text.split()) >= 100]
    english, german = ([r for r in long if r.lang == lang] for lang in ("en", "de"))
    common = Counter(w for r in long if r.lang == "en" for w in r.text.lower().split()).most_common(60)
    common = {w for w, _ in common}
    bare = [" ".join(w for w in r.text.split() if w.lower() not in common) for r in english]
    bare = [(10 ** 6 + i, t, "en", "a", 1) for i, t in enumerate(bare) if len(t.split()) >= 60][:3]
    other = [(2 * 10 ** 6 + i, r.text, "en", "a", 1) for i, r in enumerate(german[:3])]
    assert len(bare) == len(other) == 3
    added = spark.createDataFrame(bare + other, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality(docs.select(added.columns).unionByName(added)).collect()}
    for i, *_ in bare + other:
        assert not got[i].base_failed and got[i].class_distance < 0.30 and got[i].word_distance < 0.40 and not got[i].kept
    assert all(got[i].kept or got[i].base_failed for i in good)
