import os
from collections import Counter

import pytest

import corpus_pipeline
from helpers import ODD, empty_docs, odd_docs
from sieveflow.llm.queries import PIECES
from sieveflow.llm.simhash import near_groups

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary here")
SF_DIR = "/root/testdata/sf0.01"


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        b, a = before.collect(), after.collect()
        if name == "toxicity":
            gone = {r.doc_id for r in b} - {r.doc_id for r in a}
            # 33 toxic labels to learn from
            assert len(gone & toxic) > 0.6 * len(toxic) and len(a) > 0.85 * len(b)
        elif name == "exact_dedup":
            fold = Counter((r.text or "").lower() for r in a)
            assert all(n == 1 for n in fold.values()) and len({(r.text or "").lower() for r in b}) == len(fold)
        elif name == "near_dedup":
            groups = {r.component_id for r in near_groups(before).collect()}
            assert {r.doc_id for r in a} == groups and len(a) == len(groups)
        else:
            words = lambda rows: sum(len((r.text or "").split()) for r in rows)
            assert abs(words(a) - 1.5 * words(b)) < 0.05 * words(b)
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(r.doc_id for r in before.collect())


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows):
    for name, stage in corpus_pipeline.STAGES:
        docs = odd_docs(spark, True, rows) if rows else empty_docs(spark)
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert name == "sentencepiece" or out.columns == docs.columns
        assert out.count() <= 2 * len(rows)
