"""Registered queries with SQL against DuckDB."""

import pytest

import __spark_entry__ as entry
from quartermill.llm.queries import ORACLES, QUERIES


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table[n].to_pylist() for n in names])))


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got, expected = rows(QUERIES[name](spark, sf_dir).toArrow()), rows(duck.sql(ORACLES[name]).to_arrow_table())
    assert got[0] == expected[0]
    assert len(got[1]) > 0
    assert got[1] == expected[1]
