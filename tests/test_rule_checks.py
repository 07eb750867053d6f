"""Row rules from a table: equal to the single rules, extensible by rows, one scan."""

import pytest

from quartermill.operators import quality
from quartermill.plans import registry


def test_all_rules_are_the_union_of_the_single_ones(spark, sf_dir):
    rows = registry._quality_rows(spark, sf_dir)
    got = sorted(map(tuple, quality.table_rules(rows, quality.check_table(spark)).collect()))
    single = [quality.row_rules(rows, own) for own in (quality.TAX_NO_WAGE, quality.WAGE_ORDER, quality.NEGATIVE, quality.WAGE_NO_HOURS)]
    expected = sorted(tuple(r) for df in single for r in df.collect())
    bounds = {rule for rule, *_ in quality.BOUNDS}
    assert [r for r in got if r[-1] not in bounds] == expected and expected
    limits = sorted((r.worker_sk, r.year, r.quarter, r.payroll_run_sk, r.rule_code) for r in quality.bounds_rules(rows).collect())
    assert sorted((*r[:4], r[5]) for r in got if r[-1] in bounds) == limits


def test_all_rules_cost_one_scan_and_no_shuffle(spark, tmp_path):
    columns = "worker_sk long, year int, quarter int, payroll_run_sk long, state_code string, tax_type string, " + ", ".join(
        f"{name} decimal(18,2)" for name in sorted({c[3] for c in quality.ROW_CHECKS} | {"qtd_subject_amount"})
    )
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "rows"))
    found = quality.table_rules(spark.read.parquet(str(tmp_path / "rows")), quality.check_table(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_rules_come_and_go_by_rows(spark):
    rows = spark.createDataFrame(
        [(1, 1996, 1, 7, "NY", "SIT", 5.0, None), (2, 1996, 1, 7, "NY", "SIT", 50.0, 1.0), (3, 1996, 1, 7, "CA", "SIT", 50.0, 60.0), (4, 1996, 1, 7, None, None, None, 2.0)],
        "worker_sk long, year int, quarter int, payroll_run_sk long, state_code string, tax_type string, a double, b double",
    )
    def broken(*checks):
        return {(r.worker_sk, r.rule_code) for r in quality.table_rules(rows, quality.check_table(spark, checks)).collect()}

    assert broken() == set()
    assert broken(("R", None, None, "a", ">", "b")) == {(2, "R")}
    assert broken(("R", "NY", "SIT, CIT", "a", ">", "4.5"), ("R", None, None, "b", "missing", None), ("Q", None, None, "a", "none", None)) == {(1, "R"), (4, "Q")}
    assert broken(("R", None, None, "b", "outside", "2..10"), ("Q", None, None, "b", "outside", "..10")) == {(2, "R"), (3, "R"), (3, "Q")}
    for check in (("R", None, None, "c", ">", "1"), ("R", None, None, "a", "~", "1"), ("R", None, None, "a", ">", "x"), ("R", None, None, "a", ">", None), ("R", None, None, "a", "outside", "5")):
        with pytest.raises(ValueError, match="rule R"):
            broken(check)
