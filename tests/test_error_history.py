"""Catalog versions as of the error's date, and write status after a run."""

from datetime import datetime

from quartermill import schemas
from quartermill.operators import errors, skips

CATALOG = "error_code string, error_type string, category string, impacts_deposit boolean, impacts_filing boolean, effective_from timestamp"


def raised(spark, rows):
    """Open errors from (key, code, date)."""
    return spark.createDataFrame([(k, 7, code, "Open", "PENDING", None, None, None, None, day) for k, code, day in rows], schemas.ERRORS)


def test_each_error_meets_one_version(spark):
    day = [datetime(2024, 1, d) for d in range(1, 32)]
    catalog = spark.createDataFrame(
        [("A", "T0", "C0", True, True, None), ("A", "T1", "C1", True, False, day[9]), ("A", "T1", "C1", True, False, day[9]), ("A", "T1", "C0", False, False, day[9]),
         ("A", "T2", "C2", False, False, day[19]), ("B", "T9", "C9", True, True, day[9])],
        CATALOG,
    )
    rows = [(1, "A", day[0]), (2, "A", day[9]), (3, "A", day[18]), (4, "A", day[19]), (5, "A", None), (6, "B", day[8]), (7, "B", day[30]), (8, "X", day[0])]
    got = errors.active_errors(raised(spark, rows), catalog).collect()
    assert len(got) == len(rows)
    types = {r.company_error_sk: (r.error_type, r.category, r.in_catalog) for r in got}
    assert types == {
        1: ("T0", "C0", True), 2: ("T1", "C1", True), 3: ("T1", "C1", True), 4: ("T2", "C2", True), 5: ("T2", "C2", True),
        6: (None, None, False), 7: ("T9", "C9", True), 8: (None, None, False),
    }


def test_many_errors_of_one_code_do_not_multiply(spark):
    versions = [("A", f"T{i}", "C", True, True, datetime(2024, 1, 1 + i)) for i in range(20)] * 2
    catalog = spark.createDataFrame(versions, CATALOG)
    frame = raised(spark, [(i, "A", datetime(2024, 1, 1 + i % 25)) for i in range(500)])
    got = errors.active_errors(frame, catalog).collect()
    assert sorted(r.company_error_sk for r in got) == list(range(500))
    assert all(r.error_type == f"T{min(19, r.company_error_sk % 25)}" for r in got)
    # No window runs over the errors: the windowed side holds catalog rows only.
    plan = errors.active_errors(frame, catalog)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "windowspecdefinition(error_code" in plan


def test_errors_stay_pending_without_a_finished_file(spark):
    frame = spark.createDataFrame(
        [(1, 10, "A", "Open", "PENDING"), (2, 10, "A", "Open", "PENDING"), (3, 20, "A", "Open", "PENDING"), (4, 30, "A", "Open", "PENDING"),
         (5, 10, "A", "Resolved", "WRITTEN"), (6, None, "A", "Open", "PENDING"), (7, 40, "A", "Open", "PENDING")],
        "company_error_sk long, organization_unit_sk long, error_code string, resolution_status string, write_status string",
    )
    audit = spark.createDataFrame([(1, 5), (2, 0), (3, 9), (4, 9)], "company_error_sk long, removed long")
    changes = spark.createDataFrame([("B1", "S1", "GENERATED"), ("B2", "S2", "FAILED"), ("B3", "S3", "GENERATED"), ("B4", "S4", "SKIPPED")], "batch_id string, site_id string, status string")
    before = [("B1", "S1", "QUEUED"), ("B2", "S2", "QUEUED"), ("B3", "S3", "GENERATED"), ("B4", "S4", "QUEUED")]
    queue = spark.createDataFrame([(b, s, 1996, 1, None, None, status, "QUARTER") for b, s, status in before], schemas.QUEUE)
    organization = spark.createDataFrame([(10 * i, "01", f"C{i}", f"S{i}") for i in range(1, 5)], schemas.ORGANIZATION)
    units = skips.seen_units(changes, queue, organization)
    got = {r.company_error_sk: r.write_status for r in skips.write_status_after_run(frame, audit, units).collect()}
    # 3: its file failed; 4: its file was written by an earlier run; 6: of no company.
    assert got == {1: "SKIPPED", 2: "WRITTEN", 3: "PENDING", 4: "PENDING", 5: "WRITTEN", 6: "PENDING", 7: "WRITTEN"}
