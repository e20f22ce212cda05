"""The corpus queries that SQL can express, against it, on the smallest tables."""

import pytest

from oracle_check import connect, differences
from sieveflow.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, name):
    extra, missing, n = differences(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name])
    assert not extra and not missing and n
