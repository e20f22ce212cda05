import pytest
from pyspark.sql import functions as F

from helpers import ODD, empty_docs, odd_docs
from sieveflow.llm.queries import op1_quality_bayes
from sieveflow.llm.quality_bayes import _moments, quality_scores


def run(docs, labels):
    return quality_scores(docs, labels, F.col("source"), F.col("lang")).collect()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("doc_id % 5 = 0").select(F.col("doc_id").alias("k"), "quality")
    got = quality_scores(docs, labels.where("doc_id % 5 <> 0"), F.col("source"), F.col("lang"))
    rows = got.join(held, F.col("doc_id") == F.col("k")).collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_sites_shrink_to_their_parents(spark):
    """A site of many bad labels speaks for itself, one of a single bad label hardly does."""
    text = "Some words that are the same in every text of this small corpus, whatever its site may be called."
    rows, labels = [], []
    for site in range(60):
        for k in range(40 if site < 40 else 1):
            i = 100 * site + k
            rows.append((i, text, "en", f"site{site}", 1))
            labels.append((i, int(site % 2 == 0 if site < 40 else False)))
    rows += [(99999, text, "en", "unseen", 1)]
    got = {r.doc_id: r for r in run(odd_docs(spark, rows=rows), spark.createDataFrame(labels, "doc_id long, quality int"))}
    assert got[0].host_rate > 0.9 and got[100].host_rate < 0.1
    assert got[100].path_rate < got[5000].path_rate
    rate = sum(q for _, q in labels) / len(labels)
    assert got[99999].host_rate == pytest.approx(rate, abs=0.01)


def test_strength_follows_from_spread(spark):
    even = spark.createDataFrame([(50, 100)] * 20, "good long, n long")
    apart = spark.createDataFrame([(5, 100), (95, 100)] * 10, "good long, n long")
    assert _moments(even)[2] > 100 * _moments(apart)[2]


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 1), (1, 0)], [(4, 1), (5, 1)]])
def test_odd_rows(spark, labels):
    got = run(odd_docs(spark, clash=True), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r[0]) for r in ODD)
    assert all(0 <= r.score <= 1 for r in got)
    if not labels:
        assert {round(r.score, 6) for r in got} == {0.5}


def test_empty(spark):
    assert run(empty_docs(spark), spark.createDataFrame([], "doc_id long, quality int")) == []
