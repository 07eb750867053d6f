"""Behaviour that must not depend on size: packing time, periods, column types, jobs started."""

import time

import pytest
from pyspark.sql import functions as F

from quartermill.functions import packing
from quartermill.operators import skips
from quartermill.plans import registry, site_files, worker_lines
from quartermill.session import values_frame
from quartermill.sources import sample_views

import pyarrow as pa


def seconds_to_pack(spark, rows):
    row = "named_struct('juris', 'F       ', 'text', 'EJ+00000150000EK+0000000150000', 'fields', array('EJ+00000150000', 'EK+0000000150000'))"
    one = spark.range(rows).selectExpr(f"{row} AS r").groupBy().agg(F.collect_list("r").alias("rows"))
    packed = one.selectExpr(f"size({packing.pack_rows('rows', packing.tax_prefix('r.juris'))}) AS n")
    packed.collect()
    start = time.perf_counter()
    assert packed.first()["n"] == -(-2 * rows // 9) or packed.first()["n"] > rows // 6
    return time.perf_counter() - start


def test_packing_one_group_is_about_linear(spark):
    small, large = seconds_to_pack(spark, 20_000), seconds_to_pack(spark, 80_000)
    # A quadratic step would take sixteen times as long.
    assert large < 10 * max(small, 0.5)


@pytest.mark.parametrize("limit", [400, 0])
def test_periods_without_year_or_quarter_select_nothing(spark, limit):
    schema = pa.schema([("site_id", pa.string()), ("year", pa.int32()), ("quarter", pa.int32())])
    periods = values_frame(spark, schema, [("S1", 1995, 2), ("S2", None, 1), ("S3", 1996, None)])
    rows = spark.createDataFrame([(1, 1995, 2), (2, 1995, 3), (3, 1996, 1), (4, None, 1)], "worker_sk long, year int, quarter int")
    kept = worker_lines.in_periods(rows, periods, max_periods=limit)
    assert kept.schema.simpleString() == rows.schema.simpleString()
    assert [r["worker_sk"] for r in kept.collect()] == [1]


def test_hot_and_usual_lines_have_one_schema(spark, sf_dir):
    inputs = sample_views.inputs(spark, sf_dir)
    usual = site_files.line_rows(inputs)
    hot = site_files.line_rows(inputs, hot_row_limit=60)
    for one, other in zip(usual, hot):
        assert dict(one.dtypes)["seq"] == "bigint"
        assert sorted(one.dtypes) == sorted(other.dtypes)


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


@pytest.mark.parametrize("name", ["skip_jurisdiction", "skip_code", "skip_audit", "site_file_with_skips"])
def test_few_jobs_start_while_a_query_is_built(spark, sf_dir, name):
    before = jobs(spark)
    registry.QUERIES[name](spark, sf_dir)
    # Writing a table takes several jobs under adaptive execution, one a shuffle;
    # the file query writes all packets.
    assert jobs(spark) - before < (60 if name == "site_file_with_skips" else 30)


def decisions(spark, rows):
    names = "company_error_sk long, rule_id int, scope string, scope_rank int, branch_code string, company_code string, worker_sk long, jurisdiction string, tax_type string, codes array<string>"
    ranks = {"SKIP_COMPANY_OUTPUT": 1, "SKIP_COMPANY_TAX_OUTPUT": 2, "SKIP_ENTIRE_EMPLOYEE": 3, "SKIP_ALL_TAX_FOR_EMPLOYEE": 4, "SKIP_TAX_JURISDICTION": 5, "SKIP_CODE": 8}
    full = [(i, 1, scope, ranks[scope], "B", "C", worker, place, tax, codes) for i, (scope, worker, place, tax, codes) in enumerate(rows)]
    return spark.createDataFrame(full, names)


def test_tax_only_scopes_do_not_cover_worker_output(spark):
    rows = [
        ("SKIP_COMPANY_TAX_OUTPUT", None, None, None, []),
        ("SKIP_ENTIRE_EMPLOYEE", 7, None, None, []),
        ("SKIP_CODE", 8, None, None, ["CS"]),
        ("SKIP_CODE", 8, "CA", None, ["EJ"]),
        ("SKIP_CODE", 7, None, None, ["CS"]),
    ]
    got = {r["company_error_sk"]: r["effective_rank"] for r in skips.merge(decisions(spark, rows)).collect()}
    assert got == {0: 2, 1: 3, 2: 8, 3: 2, 4: 3}


def test_jurisdiction_covers_the_codes_inside_it(spark):
    rows = [
        ("SKIP_TAX_JURISDICTION", None, "CA", None, []),
        ("SKIP_CODE", 8, "CA", None, ["EJ"]),
        ("SKIP_CODE", 8, "NJ", None, ["EJ"]),
    ]
    got = [r["dominated"] for r in skips.merge(decisions(spark, rows)).orderBy("company_error_sk").collect()]
    assert got == [False, True, False]


def test_audit_counts_lines_and_worker_fields_and_base_types(spark):
    tax = spark.createDataFrame(
        [("B", "C", 7, "CA", "SUIEE"), ("B", "C", 7, "CA", "SUIER"), ("B", "C", 7, "CA", "SIT")],
        "branch_code string, company_code string, worker_sk long, jurisdiction string, tax_type string",
    )
    fields = tax.drop("tax_type").withColumn("code", F.lit("EJ"))
    people = spark.createDataFrame([("B", "C", 7), ("B", "C", 8)], "branch_code string, company_code string, worker_sk long")
    own = people.withColumn("code", F.lit("CS"))
    rows = [
        ("SKIP_ENTIRE_EMPLOYEE", 8, None, None, []),
        ("SKIP_CODE", None, None, None, ["CS"]),
        ("SKIP_TAX_JURISDICTION", None, "CA", "SUI", []),
        ("SKIP_COMPANY_OUTPUT", None, None, None, []),
        ("SKIP_COMPANY_TAX_OUTPUT", None, None, None, []),
    ]
    got = {r["company_error_sk"]: r["removed"] for r in skips.audit(decisions(spark, rows), tax, fields, people, own).collect()}
    assert got == {0: 1, 1: 2, 2: 2, 3: 5, 4: 3}
