"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from sieveflow.suite import QUERIES
from sieveflow.suite_sql import ORACLE
from oracle_check import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == ["rule_id", "lang", "n_docs"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, name):
    extra, missing, _ = differences(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name])
    assert not extra and not missing
