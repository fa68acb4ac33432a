"""Every registered query at the smallest scale, against its SQL twin where it has one."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def twins(spark):
    return entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, twins, name):
    run = entry.queries()[name]
    if name in twins:
        assert compare(spark, con, FOLDER, run, twins[name]) is None
    else:
        assert run(spark, FOLDER).count() > 0


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.columns == ["label", "chunks", "pages", "words"] and out.count() == 4


def test_twins_are_registered(twins):
    assert set(twins) <= set(entry.queries())
