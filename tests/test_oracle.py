"""Every registered query against its SQL twin on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from check import compare, connect

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    """The corpus queries have tests of their own, and not all of them have SQL."""
    from queries.registry import QUERIES

    assert {name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)} <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(name for name in ORACLE if not re.match(r"op\d+_|pipeline", name)))
def test_same_rows(name, spark, duck, sf_dir):
    assert compare(spark, duck, name, entry.queries()[name], ORACLE[name], sf_dir) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["STATUS_POD", "TGL_ENTRY", "JUMLAH", "share"]
