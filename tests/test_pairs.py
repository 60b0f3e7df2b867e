"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_pairs import compare, connect
from tabularium.registered import QUERIES

FOLDER = entry.SMALL
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["key14", "key8", "start", "company", "city", "state", "kind", "since"]
    assert df.count() == 2290


def test_no_python_in_any_plan(spark, plan):
    for name, build in entry.queries().items():
        if name in QUERIES:
            text = plan(build(spark, FOLDER))
            assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name
