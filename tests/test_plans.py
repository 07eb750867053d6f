"""Physical plan of the filing job over stored inputs."""

import re
import subprocess
import sys
from dataclasses import fields, replace
from pathlib import Path

import pytest

from quartermill.operators import taxes
from quartermill.plans import registry, site_files
from quartermill.plans.worker_lines import Inputs, in_periods
from quartermill.session import METHOD_LIMIT, stage
from quartermill.sources import sample_views


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    inputs = sample_views.inputs(spark, sf_dir)
    return Inputs(**{f.name: stage(getattr(inputs, f.name), f"input-{f.name}") for f in fields(inputs)})


def plan_text(spark, inputs):
    """The whole plan; by default long column lists are cut."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return site_files.packets(inputs)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan(spark, stored):
    return plan_text(spark, stored)


def test_each_input_is_shuffled_at_most_once_by_worker(plan):
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_worker = [e for e in exchanges if re.match(r"worker_sk#\d+L, \d+$", e)]
    assert by_worker and len(set(by_worker)) == len(by_worker) <= 4
    # Whatever else is shuffled are the few queued periods and sites.
    others = [e for e in exchanges if e not in by_worker]
    assert all(re.match(r"(year#\d+, quarter#\d+|site_id#\d+)", e) for e in others), others
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_on_the_main_path(plan):
    assert "Python" not in plan and "ArrowEval" not in plan and "Pandas" not in plan


def test_scan_reads_only_what_the_specification_shows(plan):
    snapshot = next(s for s in re.findall(r"ReadSchema: (struct<[^\n]*)", plan) if "payroll_run_sk" in s)
    for unused in ("tax_rate", "hours_worked", "qtd_overtime_amount", "out_of_state"):
        assert unused not in snapshot


def test_period_filter_reaches_the_scan(spark, stored, tmp_path):
    """Queued periods are pushed to the scan, and prune a table stored by period."""
    queue = stored.queue.filter("year = 1996 AND quarter = 4")
    plain = plan_text(spark, replace(stored, queue=queue))
    assert re.search(r"PushedFilters: \[[^\n]*EqualTo\(year,1996\)", plain)
    path = str(tmp_path / "snapshot")
    stored.snapshot.repartition("year", "quarter").write.partitionBy("year", "quarter").parquet(path)
    by_period = plan_text(spark, replace(stored, snapshot=spark.read.parquet(path), queue=queue))
    assert re.search(r"PartitionFilters: \[[^\n]*year#\d+ = 1996", by_period)


def test_many_periods_are_joined(spark, stored):
    periods = stored.queue.select("site_id", "year", "quarter").distinct()
    few, many = in_periods(stored.snapshot, periods), in_periods(stored.snapshot, periods, max_periods=3)
    assert few.count() == many.count() > 0
    assert "Join" in many._jdf.queryExecution().optimizedPlan().toString()


def test_entry_stands_a_missing_library():
    """Without a library of the optional operators the engine's queries stay."""
    code = (
        "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as entry; "
        "from quartermill.plans.registry import QUERIES; assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], check=True)


def test_audit_counts_only_workers_of_decisions(spark, sf_dir):
    plan = registry._audit(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 4


def test_lines_are_packed_once(spark, stored):
    """An inner explode would add a test of the size of the packed lines below the join."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    for rows in site_files.line_rows(stored):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("aggregate(sequence(") == 1


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_rows_meet_their_profile_where_they_are(spark, sf_dir, no_broadcast):
    plan = registry._joined(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not [e for e in exchanges if "branch_code" in e or "state_code" in e]


def test_profile_joins_are_the_same(spark, sf_dir):
    """By worker and by all five keys, with profiles of one key repeated."""
    rows, profile = registry._amounts(spark, sf_dir), registry._profile(spark, sf_dir)
    profile = profile.unionByName(profile.where("worker_sk % 7 = 1"))
    one, two = taxes.join_profile(rows, profile), taxes.join_profile_where_they_are(rows, profile)
    assert one.columns == two.columns
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()


def test_rows_read_one_by_one_move_by_order_only(spark, sf_dir):
    both = [sample_views.view(spark, sf_dir, "fx_snapshot", lines_once=flag) for flag in (False, True)]
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()
    conditions = re.findall(r"Join Inner, \((\w+)#\S+ = (\w+)#", registry._quality_rows(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString())
    assert set(conditions[0]) == {"l_orderkey", "o_orderkey"}


def test_queries_keep_methods_small_enough_to_be_compiled(spark, sf_dir):
    key, limit = METHOD_LIMIT
    try:
        spark.conf.set(key, "9000")
        registry.QUERIES["scan_worker"](spark, sf_dir)
        assert spark.conf.get(key) == "9000"
        spark.conf.unset(key)
        registry.QUERIES["scan_worker"](spark, sf_dir)
        assert spark.conf.get(key) == limit
    finally:
        spark.conf.set(key, limit)
