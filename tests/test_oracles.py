"""Every registered query against its SQL on DuckDB."""

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from quartermill.plans.oracle_sql import ORACLES
from quartermill.plans.registry import QUERIES


def plain(value):
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def rows(table: pa.Table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[[plain(v) for v in table[n].to_pylist()] for n in names])))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got = rows(QUERIES[name](spark, sf_dir).toArrow())
    expected = rows(duck.sql(ORACLES[name]).to_arrow_table())
    assert got[0] == expected[0]
    assert len(got[1]) > 0
    assert got[1] == expected[1]


def test_entry_gives_the_flagship(spark):
    assert entry.entry(spark).columns == ["site_id", "year", "quarter", "line_no", "value"]
