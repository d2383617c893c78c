"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.lake_queries()
TWINS = entry.lake_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().toString()
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", plan)
    assert difference(df, db, TWINS[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["date", "subreddit"]
