"""Unreadable input values: rejects, companies left out, other files unchanged."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quartermill import schemas
from quartermill.operators import quarantine
from quartermill.plans import site_files
from quartermill.plans.registry import _raw
from quartermill.plans.worker_lines import Inputs
from quartermill.sources import sample_views

QUEUE = "batch_id string, site_id string, year string, quarter int, window_start date, window_end date, status string, file_type string"


def test_bad_values_are_rejected_and_others_cast(spark):
    rows = [("B1", "S1", "1996", 1, None, None, "QUEUED", "QUARTER"), ("B2", "S1", "199x", 1, None, None, "QUEUED", "QUARTER"),
            ("B3", None, None, 2, None, None, None, None)]
    df = spark.createDataFrame(rows, QUEUE).withColumn("note", F.lit("kept"))
    good, rejects = quarantine.split(df, schemas.QUEUE, "queue", ("site_id",))
    assert [(r.batch_id, r.year, r.note) for r in good.collect()] == [("B1", 1996, "kept")]
    assert good.schema["year"].dataType.simpleString() == "int"
    got = sorted((r.column_name, r.value, r.reason) for r in rejects.collect())
    assert got == [("site_id", None, "MISSING_KEY"), ("year", "199x", "UNREADABLE")]
    # The plain loader stops the whole job on the same value.
    with pytest.raises(PySparkException):
        schemas.conform(df, schemas.QUEUE, "queue").collect()
    # Inputs of the declared types are passed on without a check.
    whole, none = quarantine.split(good.drop("note"), schemas.QUEUE, "queue")
    assert whole.count() == 1 and none.count() == 0


def test_other_companies_files_are_unchanged(spark, sf_dir):
    clean = sample_views.inputs(spark, sf_dir)
    checked = quarantine.check(_raw(spark, sf_dir))
    bad = {r.company_code for r in checked.companies.collect()}
    assert bad == {"C003", "C008"}
    damaged = site_files.packets(Inputs(**checked.inputs)).drop("packet")
    before = site_files.packets(clean).drop("packet").where(~F.col("company_code").isin(*bad))
    assert Counter(map(str, damaged.collect())) == Counter(map(str, before.collect()))


def test_reject_without_company_takes_its_workers(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    worker = sample_views.view(spark, sf_dir, "fx_worker").orderBy("worker_sk").first()
    raw = {name: sample_views.view(spark, sf_dir, view) for name, view in sample_views.INPUT_VIEWS.items()}
    allowances = F.when(F.col("worker_sk") == worker.worker_sk, F.lit("two")).otherwise(F.col("number_of_allowances").cast("string"))
    raw["profile"] = raw["profile"].drop("branch_code", "company_code").withColumns(
        {"number_of_allowances": allowances, "branch_code": F.lit(None).cast("string"), "company_code": F.lit(None).cast("string")}
    )
    has_profile = raw["profile"].where(F.col("worker_sk") == worker.worker_sk).count()
    checked = quarantine.check(raw)
    assert [tuple(r) for r in checked.companies.collect()] == [(worker.branch_code, worker.company_code)] * min(1, has_profile)
    kept = quarantine.check(raw, leave_out=False)
    assert kept.inputs["worker"].count() == raw["worker"].count()


def test_partial_files_can_count_as_failed(spark):
    changes = spark.createDataFrame(
        [("B1", "S1", "GENERATED", None), ("B2", "S2", "GENERATED", None), ("B3", "S1", "FAILED", "no data"), ("B4", "S1", "GENERATED", None), ("B5", "S1", "SKIPPED", None)],
        "batch_id string, site_id string, status string, error_message string",
    )
    rows = [(f"B{i}", f"S{1 + (i == 2)}", "1996", 1, None, None, "QUEUED" if i != 4 else "GENERATED", "QUARTER") for i in range(1, 6)]
    queue = schemas.conform(spark.createDataFrame(rows, QUEUE), schemas.QUEUE, "queue")
    companies = spark.createDataFrame([("01", "C1"), ("01", "C2")], "branch_code string, company_code string")
    organization = spark.createDataFrame([(1, "01", "C1", "S1"), (2, "01", "C2", "S1"), (3, "01", "C3", "S2")], schemas.ORGANIZATION)
    got = {r.batch_id: (r.status, r.error_message) for r in quarantine.mark_status(changes, queue, companies, organization, "FAILED").collect()}
    note = "2 companies left out for unreadable input, first: 01/C1"
    assert got == {
        "B1": ("FAILED", note), "B2": ("GENERATED", None), "B3": ("FAILED", f"no data; {note}"), "B4": ("GENERATED", None), "B5": ("SKIPPED", None),
    }
