"""Rules from a table: sides, groups, places, dates, and nothing skipped without one."""

from datetime import date, datetime

from pyspark.sql import functions as F

from quartermill import schemas
from quartermill.operators import errors, skips
from quartermill.plans import site_files
from quartermill.plans.registry import _in

RESOLVED = """company_error_sk long, error_code string, resolved_category string, resolved_by string, in_catalog boolean, impacts_deposit boolean,
    impacts_filing boolean, organization_unit_sk long, state_code string, local_code string, tax_type string, worker_sk long"""
ORG = [(1, "01", "C1", "S1")]


def decided(spark, rows, rules, groups=None):
    """(error, rule, scope, side, codes) for errors given as (key, category, state, day)."""
    resolved = spark.createDataFrame([(k, "E", c, "CATEGORY", True, True, True, 1, state, None, None, None) for k, c, state, _ in rows], RESOLVED)
    raised = spark.createDataFrame([(k, 1, "E", "Open", "PENDING", state, None, None, None, day) for k, _, state, day in rows], schemas.ERRORS)
    table = None if rules is None else spark.createDataFrame(rules, errors.RULE_TABLE)
    groups = None if groups is None else spark.createDataFrame(groups, "reporting_group string, code string")
    organization = spark.createDataFrame(ORG, schemas.ORGANIZATION)
    found = errors.resolve_by_table(resolved, raised, table, organization, groups).collect()
    return sorted((r.company_error_sk, r.rule_id or 0, r.scope, r.side, tuple(r.codes), r.unmapped) for r in found)


def rule(number, category="A", side=None, scope="SKIP_CODE", codes=(), group=None, place=None, active=None, since=None, until=None):
    return number, category, side, scope, None, list(codes), group, place, active, since, until


def test_dates_groups_places_and_inactive_rules(spark):
    rows = [(1, "A", None, datetime(2024, 1, 5)), (2, "A", "CA", datetime(2024, 1, 20)), (3, "A", None, None), (4, "B", None, datetime(2024, 1, 5))]
    rules = [
        rule(1, side="tax", codes=["EJ"], until=date(2024, 1, 5)),
        rule(2, scope="SKIP_TAX_JURISDICTION", place=True),
        rule(3, codes=["EK", "DD"], group="G", since=date(2024, 1, 6)),
        rule(4, codes=["ZZ"], active=False),
        rule(5, side="WORKER", codes=["CS"]),
    ]
    assert decided(spark, rows, rules, [("G", "DD"), ("G", "SY"), ("H", "EJ")]) == [
        (1, 1, "SKIP_CODE", "TAX", ("EJ",), False),
        (1, 5, "SKIP_CODE", "WORKER", ("CS",), False),
        (2, 2, "SKIP_TAX_JURISDICTION", "BOTH", (), False),
        (2, 3, "SKIP_CODE", "BOTH", ("DD", "EK", "SY"), False),
        (2, 5, "SKIP_CODE", "WORKER", ("CS",), False),
        (3, 5, "SKIP_CODE", "WORKER", ("CS",), False),
        (4, 0, "NO_SKIP", "BOTH", (), True),
    ]


def test_nothing_is_skipped_without_a_table(spark):
    rows = [(1, "A", None, datetime(2024, 1, 5)), (2, "B", None, None)]
    for rules in (None, []):
        assert decided(spark, rows, rules) == [(1, 0, "NO_SKIP", "BOTH", (), True), (2, 0, "NO_SKIP", "BOTH", (), True)]


def test_a_side_keeps_the_code_on_the_other_side(spark, sf_dir):
    """The same codes for all companies, on one side each: employee lines and tax lines change one at a time."""
    inputs = _in(spark, sf_dir)
    companies = inputs.organization.select("branch_code", "company_code").distinct()

    def fields(side):
        """(employee lines, tax lines) as text that still hold a given name, and a federal amount."""
        decisions = companies.selectExpr(
            "1L AS company_error_sk", "1 AS rule_id", "'SKIP_CODE' AS scope", "branch_code", "company_code", "CAST(NULL AS BIGINT) AS worker_sk",
            "CAST(NULL AS STRING) AS jurisdiction", "CAST(NULL AS STRING) AS tax_type", "array('CS', 'EJ') AS codes", f"'{side}' AS side",
        )
        lines = site_files.packets(inputs, decisions=skips.PacketDecisions.fold(decisions)).select(F.explode("lines").alias("line"))
        own, tax = F.col("line").startswith("******      "), F.col("line").startswith("******F     ")
        return lines.agg(F.sum((own & F.col("line").contains("CSGIV")).cast("int")), F.sum((tax & F.col("line").contains("EJ+")).cast("int"))).first()

    name, amount = fields("WORKER"), fields("TAX")
    assert name[0] == 0 and name[1] > 0
    assert amount[0] > 0 and amount[1] == 0
    assert tuple(fields("BOTH")) == (0, 0)
