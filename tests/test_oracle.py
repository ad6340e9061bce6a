"""Every registered query against its SQL twin, at the smallest scale."""

import pytest

from __spark_entry__ import entry, queries

from .oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    text, _ = difference(spark, con, name, SF)
    assert text == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["source_file", "report_key", "text_plain"]
    assert df.count() == 200
