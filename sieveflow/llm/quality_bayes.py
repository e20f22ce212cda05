"""Quality by hierarchical empirical Bayes: what a document says, and where it comes from.

1. **Evidence of the document.** A handful of measures of the text (repetition, lines, symbols, capitals, word length,
   size) are cut into bins. Labelled documents are counted by bin and label, and each bin's smoothed
   log-likelihood ratio is what a measure says; measures that say the same thing share their weight by a common factor, fitted
   on the counts of at most `MAX_FIT` labelled rows.
2. **Evidence of the site.** Good and bad labelled documents are counted per host and per path of a host. A host's
   rate is drawn towards the global rate, a path's towards its host's; how strongly follows from how much
   rates differ between sites with labels (method of moments), so a site of a few labels says next to nothing
   and one of many speaks for itself. Sites without labels have the rate of the level above.
3. **Together.** The posterior odds are the odds of the path times the likelihood ratio of the document.

All counting is grouped aggregation with partial sums; per level one row of sums reaches the driver. Sites are
joined by key without hint, so their number may grow with the data.

Defined results: a NULL text counts as empty and has its own bins. NULL hosts and paths are sites of their own. Labels of
NULL ids and NULL labels are left out; of several labels of an id the lowest counts. Without labels
every score is 0.5. NULL ids and repeated rows stay. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, WORD, first_by_hash

MAX_FIT = 50_000
SMOOTHING = 1.0
THRESHOLD = 0.3         # leans to keeping
SHORT = 25              # words below which shares of a text mean something else, so it has bins of its own
# measure -> upper bounds of its bins
BINS = {
    "distinct": (0.2, 0.35, 0.5, 0.65, 0.8, 0.95),
    "dup_lines": (0.001, 0.1, 0.3, 0.5),
    "symbols": (0.001, 0.01, 0.05, 0.1),
    "capitals": (0.01, 0.05, 0.1, 0.3, 0.6),
    "marks": (0.005, 0.02, 0.05, 0.1, 0.2),
    "word_length": (2.5, 3.5, 4.5, 6.0, 8.0, 12.0),
    "n_words": (5, 20, 50, 100, 300, 1000, 5000),
}


def measures(text: Column) -> dict[str, Column]:
    """Measures of a text by built-in functions."""
    n_chars = F.greatest(F.char_length(text), F.lit(1))
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    n_words = F.size(words)
    lines = F.filter(F.split(text, "\n"), lambda l: F.rlike(l, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "distinct": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1)),
        "dup_lines": 1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")) / n_chars,
        "capitals": F.regexp_count(text, F.lit(r"\p{Lu}")) / n_chars,
        "marks": F.regexp_count(text, F.lit(r"\p{P}")) / n_chars,
        "word_length": F.char_length(F.array_join(words, "")) / F.greatest(n_words, F.lit(1)),
        "n_words": n_words.cast("double"),
    }


def _bin(value: Column, bounds) -> Column:
    out = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        out = F.when(value <= bounds[i], F.lit(i)).otherwise(out)
    return out


def _moments(sites: DataFrame) -> tuple[float, float, int]:
    """(good, all, strength): the strength is the number of labels that a prior is worth.

    Rates of sites vary by chance and by what the sites are. What chance leaves unexplained is the
    variance between sites, and the prior is worth as many labels as make a rate vary that much.
    """
    row = sites.agg(F.sum("good"), F.sum("n"), F.count("*"), F.sum(F.col("n") * F.col("n")),
                    F.sum(F.col("good") * F.col("good") / F.col("n"))).first()
    good, n, k, n2, sum_np2 = (float(v or 0) for v in row)
    if n == 0 or k < 2:
        return good, n, 1
    p = good / n
    if p in (0.0, 1.0):
        return good, n, 1000
    between = (sum_np2 - n * p * p - (k - 1) * p * (1 - p)) / max(n - n2 / n - (k - 1), 1e-9)
    between = min(max(between, p * (1 - p) / 1000), p * (1 - p) / 2)
    return good, n, p * (1 - p) / between - 1


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def quality_scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_id: str = "doc_id", label_col: str = "quality", threshold: float = THRESHOLD, max_fit: int = MAX_FIT) -> DataFrame:
    """One row per document: doc_id, evidence (log-likelihood ratio), host_rate, path_rate, score, kept.

    `host` and `path` are Columns of `docs`; a path is within its host.
    """
    scratch = Scratch(docs.sparkSession, "bayes")
    names = list(BINS)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), host.alias("host"), path.alias("path"), text.alias("text"))
    rows = rows.select("doc_id", "host", "path", *(v.alias(k) for k, v in measures(F.col("text")).items()))
    short = (F.col("n_words") < SHORT).cast("int")
    rows = scratch.store(rows.select("doc_id", "host", "path", *(
        (_bin(F.col(k), b) + short * (len(b) + 1)).alias(k) for k, b in BINS.items())))
    marks = labels.select(F.col(f"`{label_id}`").alias("k"), F.col(f"`{label_col}`").cast("int").alias("good")).where(
        "k IS NOT NULL AND good IS NOT NULL").groupBy("k").agg(F.min("good").alias("good"))
    labelled = scratch.store(rows.join(marks, F.col("doc_id") == F.col("k")).drop("k"))

    # counts by measure, bin and label: as many rows as there are bins
    counts = labelled.select("good", F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.col(k).alias("bin")) for k in names))).alias("b"))
    counted = {(r.measure, r.bin): (r.good_n, r.n - r.good_n) for r in counts.groupBy("b.measure", "b.bin").agg(
        F.sum("good").alias("good_n"), F.count("*").alias("n")).collect()}
    ratios = {}
    for k, bounds in BINS.items():
        cells = [counted.get((k, i), (0, 0)) for i in range(2 * (len(bounds) + 1))]
        good, bad = (sum(c[i] for c in cells) + SMOOTHING * len(cells) for i in (0, 1))
        ratios[k] = [math.log((g + SMOOTHING) / good) - math.log((b + SMOOTHING) / bad) for g, b in cells]
    ratio = sum((F.element_at(F.array(*(F.lit(float(x)) for x in ratios[k])), F.col(k) + 1) for k in names), F.lit(0.0))
    weight = _common_weight(labelled.select("doc_id", "good", ratio.alias("x")), max_fit)

    hosts = scratch.store(labelled.groupBy("host").agg(F.sum("good").alias("good"), F.count("*").alias("n")))
    good, n, strength = _moments(hosts)
    rate = (good + 0.5) / (n + 1.0)
    paths = scratch.store(labelled.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")))
    _, _, path_strength = _moments(paths)
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("good") + strength * rate) / (F.col("n") + strength)).alias("host_rate"))
    up = F.coalesce("host_rate", F.lit(rate))
    paths = paths.select(F.col("host").alias("ph"), F.col("path").alias("pp"), F.col("good").alias("pg"), F.col("n").alias("pn"))
    placed = rows.join(hosts, F.col("host").eqNullSafe(F.col("h")), "left").join(
        paths, F.col("host").eqNullSafe(F.col("ph")) & F.col("path").eqNullSafe(F.col("pp")), "left")
    placed = placed.select("doc_id", (weight * ratio).alias("evidence"), up.alias("host_rate"), (
        (F.coalesce("pg", F.lit(0)) + path_strength * up) / (F.coalesce("pn", F.lit(0)) + path_strength)).alias("path_rate"))
    safe = F.least(F.greatest("path_rate", F.lit(1e-6)), F.lit(1 - 1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(safe))))
    return placed.withColumn("score", score).withColumn("kept", F.col("score") >= threshold)


def _common_weight(sample: DataFrame, max_fit: int) -> float:
    """What the sum of ratios is to be multiplied by: 1 if the measures were independent, less as they overlap."""
    rows = first_by_hash(sample, "doc_id", max_fit).toPandas()
    if rows.empty or rows["good"].nunique() < 2:
        return 1.0
    x, y = rows["x"].to_numpy(float), rows["good"].to_numpy(float)
    offset, w = math.log(y.mean() / (1 - y.mean())), 1.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(offset + w * x, -30, 30)))
        # drawn to 1 as by a handful of rows
        step = (x @ (y - p) - 4.0 * (w - 1.0)) / ((x * x) @ (p * (1 - p)) + 4.0)
        w = min(max(w + step, 0.05), 2.0)
    return w
