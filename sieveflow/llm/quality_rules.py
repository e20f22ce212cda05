"""Quality rules: counts per text, then how far its make-up diverges from its language.

The base rules refuse texts of few words and texts whose words mostly lie in repeated windows.
What passes is compared with its language: the histogram over character classes and the one over
the language's common words, each by Jensen-Shannon distance (0 to 1) to the histogram of all
passing texts of that language. Distances of short texts are mostly noise, so a text is only refused
by one if it has enough characters or words. Common words cover a sixth of a language, so a text with none
of them is at a distance of about 0.29 only: overuse is judged by a fixed limit, want of them by the
share of the distance that a text of the same language without any common word has.

Two passes over the texts: one counts words per language (partial sums before the shuffle), one
takes all counts of a text inside its row. Only built-in functions are used. What joins the texts is one
row per language with at most 1 / `COMMON` words; there is no hint, so Spark broadcasts it if its
table is small and splits a language with most of the rows otherwise.

Defined results: a NULL text has no words and fails the base rules. NULL is a language of its
own. A language none of whose texts passes has no reference, and its texts are judged by the base
rules alone. NULL ids and repeated rows stay, each with its verdict. An empty table gives an
empty table. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from .common import WORD, Scratch

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"
GRAM = 5
COMMON = 0.01               # share of a language's words from which a word is common
MIN_CHARS_CLASSES = 200
MIN_WORDS_COMMON = 60
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.40
MAX_WORD_SHARE = 0.92       # of the distance of a text without any common word
MIN_EXPECTED = 8            # common words that a text of its length should have, to be refused for too few
# character classes counted by a pattern; white space and all the rest are classes of their own
CLASSES = (r"\p{Lu}", r"\p{Nd}", r"\p{P}", r"\p{S}")


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows that stand in the text more than once."""
    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["g"] == x["g"]))
                         | (F.get(ordered, i + 1)["g"] == x["g"]))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(-GRAM).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(places, start, lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(GRAM), at - acc["last"])).alias("n")))["n"]

    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    # most texts repeat no window, which a hash set finds out sooner than a sort
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(ordered, covered)).otherwise(F.lit(0).cast("long"))


def common_words(docs: DataFrame, text_col: str, lang_col: str, scratch: Scratch) -> DataFrame:
    """(lang, common, share): per language its common words and their shares of all its words."""
    words = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.explode(F.regexp_extract_all(
        F.lower(F.col(f"`{text_col}`")), F.lit(WORD), F.lit(0))).alias("w"))
    counts = scratch.store(words.groupBy("lang", "w").agg(F.count("*").alias("n")))
    totals = counts.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("total"))
    frequent = counts.join(totals, F.col("lang").eqNullSafe(F.col("of"))).where(F.col("n") >= COMMON * F.col("total"))
    pairs = F.sort_array(F.collect_list(F.struct("w", (F.col("n") / F.col("total")).alias("p"))))
    return frequent.groupBy("lang").agg(pairs.alias("c")).select(
        "lang", F.transform("c", lambda x: x["w"]).alias("common"), F.transform("c", lambda x: x["p"]).alias("share"))


def _counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, common: DataFrame) -> DataFrame:
    """All counts of a text, taken in its row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ref = common.select(F.col("lang").alias("of"), "common", "share")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), text.alias("text"))
    rows = rows.join(ref, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumns({
        "spaced": F.array_join("words", " "),
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "lines": F.filter(F.split("text", "\n"), lambda l: F.rlike(l, F.lit(r"[^\x20\x09-\x0D]"))),
    })
    rows = rows.withColumns({
        # one match of no width before each word that begins a window
        "grams": F.regexp_extract_all("spaced", F.lit(rf"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{GRAM - 1}}}))"), F.lit(1)),
        # doubled spaces, so that neighbours do not share one
        "padded": F.concat(F.lit(" "), F.lower(F.replace("spaced", F.lit(" "), F.lit("  "))), F.lit(" ")),
    })
    classes = [F.regexp_count("text", F.lit(c)).cast("long") for c in CLASSES]
    space = F.char_length("text") - F.col("word_chars")
    rest = F.char_length("text") - space - sum(classes[1:], classes[0])

    def count(padded: Column, word: Column) -> Column:
        wide = F.concat(F.lit(" "), word, F.lit(" "))
        return ((F.octet_length(padded) - F.octet_length(F.replace(padded, wide, F.lit("")))) / F.octet_length(wide)).cast("long")

    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("grams")).alias("n_repeat_words"),
        F.array(*classes, space, rest).alias("classes"),
        F.transform("common", lambda w: count(F.col("padded"), w)).alias("common"), "share")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays that each sum to 1."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: let((x + y) / 2, lambda m: (part(x, m) + part(y, m)) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)))


def _with_rest(shares: Column) -> Column:
    """Shares and what is missing to 1."""
    return F.concat(shares, F.array(F.greatest(F.lit(0.0), 1.0 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x))))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
            max_word_share: float = MAX_WORD_SHARE) -> DataFrame:
    """One row per document: its counts, base_failed, both distances (NULL where not judged), kept."""
    scratch = Scratch(docs.sparkSession, "quality")
    common = scratch.store(common_words(docs, text_col, lang_col, scratch))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = scratch.store(_counts(docs, id_col, text_col, lang_col, common).withColumn("base_failed", failed))
    n_classes = len(CLASSES) + 2
    sums = counts.where("NOT base_failed").groupBy(F.col("lang").alias("of")).agg(
        F.array(*(F.sum(F.get("classes", F.lit(i))) for i in range(n_classes))).alias("sums"))
    reference = scratch.store(sums.select("of", F.transform(
        "sums", lambda s: s / F.aggregate("sums", F.lit(0).cast("long"), lambda a, x: a + x)).alias("expected")))
    n_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    judged = counts.join(reference, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn("n_chars", n_chars)
    class_distance = F.when((F.col("n_chars") >= MIN_CHARS_CLASSES) & F.col("expected").isNotNull(), js_distance(
        F.transform("classes", lambda c: c / F.col("n_chars")), F.col("expected")))
    word_distance = F.when((F.col("n_words") >= MIN_WORDS_COMMON) & F.col("common").isNotNull(), js_distance(
        _with_rest(F.transform("common", lambda c: c / F.col("n_words"))), _with_rest(F.col("share"))))
    coverage = F.aggregate("share", F.lit(0.0), lambda a, x: a + x)
    n_common = F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    none = js_distance(_with_rest(F.transform("share", lambda x: F.lit(0.0))), _with_rest(F.col("share")))
    rows = judged.withColumns({"class_distance": class_distance, "word_distance": word_distance})
    wanting = (F.col("n_words") * coverage >= MIN_EXPECTED) & (n_common < F.col("n_words") * coverage) & (
        F.col("word_distance") >= max_word_share * none)
    diverges = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > max_word_distance) | F.coalesce(wanting, F.lit(False))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & ~diverges).alias("kept"), "class_distance", "word_distance")
