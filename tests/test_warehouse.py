"""Planned key ranges of warehouse scans, without a database server."""

import duckdb
import pytest

from quartermill.sources import warehouse

SETTINGS = warehouse.Warehouse("jdbc:none://host/db", "u", "p", "none.Driver", "pay")


class Reader:
    """Notes what a scan asks for; planning queries are answered by DuckDB in this process."""

    def __init__(self, db, options=None):
        self.db, self.options = db, options if options is not None else {}

    @property
    def read(self):
        return Reader(self.db)

    def format(self, name):
        return self

    def option(self, key, value):
        return Reader(self.db, self.options | {key: value})

    def load(self):
        self.rows = self.db.execute(self.options["query"]).fetchall() if "query" in self.options else None
        return self

    def jdbc(self, url, table, predicates):
        return Reader(self.db, self.options | {"url": url, "dbtable": table, "predicates": predicates})

    def collect(self):
        return self.rows

    def first(self):
        return self.rows[0]


@pytest.fixture
def db():
    found = duckdb.connect()
    found.execute("CREATE SCHEMA pay")
    # Half of the keys lie in a narrow span, one is far off, one key repeats, some are missing.
    found.execute("CREATE TABLE pay.worker AS SELECT i AS k FROM range(1000) t(i) UNION ALL SELECT 50000 + i * 37 FROM range(1000) t(i)")
    found.execute("INSERT INTO pay.worker SELECT 10000000 UNION ALL SELECT NULL FROM range(5) UNION ALL SELECT 7 FROM range(300)")
    yield found
    found.close()


def sizes(db, source, conditions):
    return [db.execute(f"SELECT count(*) FROM {source} WHERE {c}").fetchone()[0] for c in conditions]


@pytest.mark.parametrize("by_rows", [True, False])
@pytest.mark.parametrize("source", ["pay.worker", "(SELECT k FROM pay.worker WHERE k % 2 = 0 OR k IS NULL) q"])
def test_every_row_is_in_one_range(db, by_rows, source):
    got = SETTINGS._split(Reader(db), source, "k", 8, 60, by_rows)
    found = sizes(db, source, got.options["predicates"])
    assert got.options["dbtable"] == source and got.options["queryTimeout"] == 60 and len(found) == 8
    assert sum(found) == db.execute(f"SELECT count(*) FROM {source}").fetchone()[0]
    if by_rows:
        # A repeated key stays in one range, so a range exceeds its share by its copies at most.
        assert max(found) <= sum(found) / 8 + 306
    else:
        assert max(found) > sum(found) / 2


def test_query_splits_only_on_request(db):
    whole = SETTINGS.query(Reader(db), "SELECT k FROM pay.worker")
    assert whole.options["query"] == "SELECT k FROM pay.worker" and "predicates" not in whole.options
    split = SETTINGS.query(Reader(db), "SELECT k FROM pay.worker", partition_column="k", partitions=4)
    assert split.options["dbtable"] == "(SELECT k FROM pay.worker) q" and len(split.options["predicates"]) == 4


def test_table_plans_its_ranges_unless_bounds_are_given(db, monkeypatch):
    monkeypatch.setattr(warehouse, "conform", lambda df, declared, name: df)
    planned = SETTINGS.table(Reader(db), "worker", None, "k", partitions=4)
    assert len(planned.options["predicates"]) == 4
    given = SETTINGS.table(Reader(db), "worker", None, "k", (0, 100), 4)
    assert (given.options["lowerBound"], given.options["upperBound"], given.options["numPartitions"]) == (0, 100, 4)
    assert "partitionColumn" not in SETTINGS.table(Reader(db), "worker", None).options


def test_empty_and_single_key_tables(db):
    db.execute("CREATE TABLE pay.none AS SELECT k FROM pay.worker LIMIT 0")
    for by_rows in (True, False):
        assert SETTINGS._split(Reader(db), "pay.none", "k", 4, 60, by_rows).options["predicates"] == ["1 = 1"]
        one = SETTINGS._split(Reader(db), "(SELECT 7 AS k) q", "k", 4, 60, by_rows)
        assert one.options["predicates"] == ["1 = 1"]
    assert warehouse.predicates("k", [3, 1, 2, 2]) == ["(k < 2 OR k IS NULL)", "k >= 2 AND k < 3", "k >= 3"]
