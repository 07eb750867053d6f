"""Line counts of the audit against the filing job run with each decision alone."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quartermill.operators import queue, skips
from quartermill.plans import line_audit
from quartermill.plans.registry import _groups, _in
from quartermill.plans.worker_lines import worker_lines_of
from quartermill.specs.compile import default_specs

DECISIONS = """company_error_sk long, rule_id int, error_code string, resolved_category string, scope string, branch_code string,
    company_code string, worker_sk long, jurisdiction string, tax_type string, codes array<string>"""


def sums(spark, inputs, decisions=None):
    """(employee lines, tax lines) by file and company, as the job packs them."""
    periods = queue.site_periods(inputs.queue)
    lines = worker_lines_of(inputs, periods, default_specs(), decisions)
    rows = lines.groupBy(*line_audit.FILE).agg(F.sum(F.size("worker_lines")).alias("own"), F.sum(F.size("tax_lines")).alias("tax")).collect()
    return defaultdict(lambda: (0, 0), {tuple(r[:5]): (r.own, r.tax) for r in rows})


@pytest.fixture(scope="module")
def cases(spark, sf_dir):
    inputs = _in(spark, sf_dir)
    people = inputs.worker.join(inputs.snapshot.select("worker_sk").distinct(), "worker_sk", "left_semi").orderBy("worker_sk").collect()
    one, two = people[3], people[10]
    a, b = (one.branch_code, one.company_code), (two.branch_code, two.company_code)
    rows = [
        (1, 1, "SKIP_COMPANY_OUTPUT", *a, None, None, None, []),
        (2, 1, "SKIP_COMPANY_TAX_OUTPUT", *a, None, None, None, []),
        (3, 1, "SKIP_ENTIRE_EMPLOYEE", *b, two.worker_sk, None, None, []),
        (4, 1, "SKIP_ALL_TAX_FOR_EMPLOYEE", *b, two.worker_sk, None, None, []),
        (5, 1, "SKIP_TAX_JURISDICTION", *a, None, "F", None, []),
        (6, 1, "SKIP_TAX_JURISDICTION", *a, None, "CA", "SUI", []),
        (7, 1, "SKIP_CODE", *a, None, None, None, ["EJ", "CS", "CU", "DD", "EK", "MV"]),
        (8, 1, "SKIP_CODE", *b, two.worker_sk, "F", None, ["EJ", "EK"]),
        (9, 1, "SKIP_REPORTING_CODES", *b, None, None, None, []),
        (10, 2, "SKIP_CODE", *a, None, None, None, ["EJ", "CS", "CU", "DD", "EK", "MV"]),
        (11, 1, "SKIP_ENTIRE_EMPLOYEE", *a, None, None, None, []),
        (12, 1, "NO_SKIP", *a, None, None, None, []),
        (13, 1, "SKIP_ENTIRE_EMPLOYEE", *a, -5, None, None, []),
    ]
    frame = spark.createDataFrame([(*r[:2], "E", "C", *r[2:]) for r in rows], DECISIONS)
    active = spark.createDataFrame([(i, "PAYROLL", True, False) for i in range(1, 14)], "company_error_sk long, category string, impacts_deposit boolean, impacts_filing boolean")
    return inputs, frame, line_audit.audit(inputs, frame, active, groups=_groups(spark)).collect()


def test_counts_equal_runs_with_one_decision_each(spark, cases):
    inputs, frame, found = cases
    base = sums(spark, inputs)
    for key in (1, 4, 5, 6, 7, 8, 9):
        own = frame.where(F.col("company_error_sk") == key)
        after = sums(spark, inputs, skips.PacketDecisions.fold(own, _groups(spark)))
        rows = [r for r in found if r.company_error_sk == key]
        files = {(r.site_id, r.year, r.quarter, r.branch_code, r.company_code) for r in rows}
        assert rows and all(f[0] is not None for f in files)
        for r in rows:
            file = (r.site_id, r.year, r.quarter, r.branch_code, r.company_code)
            assert (r.worker_lines_before, r.tax_lines_before) == base[file]
            assert (r.worker_lines_after, r.tax_lines_after) == after[file]
        # Nothing outside the listed files changes.
        assert all(after[f] == base[f] for f in base if f not in files)
    changed = {r.company_error_sk for r in found if (r.worker_lines_before, r.tax_lines_before) != (r.worker_lines_after, r.tax_lines_after)}
    assert {1, 2, 3, 4, 5, 7} <= changed


def test_every_skipping_decision_has_rows(cases):
    _, _, found = cases
    assert {r.company_error_sk for r in found} == {*range(1, 12), 13}
    lone = {r.company_error_sk: r for r in found if r.site_id is None}
    # No worker to skip, or none that a queued file knows.
    assert set(lone) == {11, 13}
    assert all((r.worker_lines_before, r.worker_lines_after, r.tax_lines_before, r.tax_lines_after) == (0, 0, 0, 0) for r in lone.values())
    same = {7: [], 10: []}
    for r in found:
        if r.company_error_sk in same:
            same[r.company_error_sk].append((r.site_id, r.year, r.quarter, r.worker_lines_after, r.tax_lines_after))
    assert sorted(same[7]) == sorted(same[10])
    assert {(r.category, r.impacts_deposit, r.impacts_filing) for r in found} == {("PAYROLL", True, False)}
