"""Specifications, errors, queue and loaders."""

import pytest
from pyspark.sql import functions as F

from quartermill import schemas
from quartermill.functions.text import impact_flag, normalize_category
from quartermill.operators import errors, queue, sizing
from quartermill.sources import feed
from quartermill.specs import compile as specs, fixed_values as fixed


def test_default_specs_have_the_known_shape():
    base = specs.default_specs()
    assert (len(base.fields), len(base.tax), len(base.pairs)) == (36, 17, 5)
    assert len({m for _, m, *_ in [(0, *s) for s in fixed.table(fixed.TAX_SLOTS)]}) == 23
    assert base.mandatory() == {"7H": ("qtd_amount", "SSEE-QTD"), "5H": ("ytd_amount", "SSEE"), "5E": ("ytd_amount", "MEDEE")}
    assert all(len(row[2]) == 2 for row in base.fields + base.tax)


def test_catalog_profile_of_the_fixed_catalog(spark):
    rows = {r["category"]: r["row_count"] for r in errors.catalog_profile(errors.default_catalog(spark)).collect()}
    assert rows == {"PAYROLL": 45, "COMPANY": 18, "WORKER_PROFILE": 11, "WagePlan": 4, "EMPLOYEE": 1, "Registration": 1, "Validation": 1}


@pytest.mark.parametrize(
    "raw, area, scope",
    [
        ("Company", "PERIODIC", "COMPANY"), ("WORKER_PROFILE", "QUARTER", "WORKER"), ("Payroll & Tax", "QUARTER", "WORKER"),
        ("PAYROLL", "QUARTER", "WORKER"), ("WagePlan", "UNKNOWN", "UNKNOWN"), (None, "UNKNOWN", "UNKNOWN"),
    ],
)
def test_classification(spark, raw, area, scope):
    df = spark.createDataFrame([(raw,)], "category string")
    row = errors.classify(df).first()
    assert (row["processing_area"], row["presentation_scope"]) == (area, scope)


def test_normalization(spark):
    df = spark.createDataFrame([(" payroll  &   tax ",), (None,), ("",), ("  ",), ("&",)], "c string")
    assert [r[0] for r in df.select(normalize_category(F.col("c"))).collect()] == ["PAYROLL_AND_TAX", "UNKNOWN", "UNKNOWN", "UNKNOWN", "AND"]


def test_impact_flags(spark):
    df = spark.createDataFrame([("Y",), ("true",), ("1",), (" Yes ",), ("N",), ("false",), (None,)], "v string")
    assert [r[0] for r in df.select(impact_flag(F.col("v"))).collect()] == [True, True, True, True, False, False, False]
    booleans = spark.createDataFrame([(True,), (False,)], "v boolean")
    assert [r[0] for r in booleans.select(impact_flag(F.col("v"))).collect()] == [True, False]


def feed_rows(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, tax_code string, field_code string, token string")


def spec_rows(spark):
    raw = spark.createDataFrame(
        [("7H", 12, "N", 2, "Y", None, None), ("DF", 1, "X", None, None, None, None), ("ZZ", 3, "Q", None, None, None, None),
         ("SY", 10, "X", None, None, "DATE", None), ("CS", 12, "X", None, None, None, None), ("Z9", 9, "X", None, None, None, None)],
        "field_code string, field_length int, data_type string, decimal_places int, signed string, category_1 string, category_2 string",
    )
    levels = spark.createDataFrame(
        [("CS", "EES", "Q"), ("CS", "EEF", "Q"), ("SY", "EEF", "A"), ("Z9", "EEL", "Q")], "field_code string, record_code string, file_code string"
    )
    return specs.compile_field_spec(raw, levels)


def test_feed_compiles_with_last_row_winning(spark):
    items = feed_rows(spark, [
        (1, "SSEE", "7H", "QTDTAXW"), (2, "SSEE", "DF", "QTDW"), (3, "FIT", "DF", "CD-MARITAL-STS"), (4, "FIT", "7H", "NOPE"),
        (5, "FIT", "ZZ", "QTDT"), (6, "", "7H", "QTDT"), (7, "SSER", None, "QTDT"),
    ])
    got = {(r["measure"], r["tax_type"]): (r["code"], r["decimals"], r["signed"], r["mandatory"]) for r in specs.tax_spec_from_feed(items, spec_rows(spark)).collect()}
    assert got == {("qtd_taxable_amount", "SSEE"): ("DF", 2, True, False), ("filing_status", "FIT"): ("DF", 2, True, False)}
    pairs = specs.tax_pairs(items).collect()
    assert [tuple(p) for p in pairs] == [("SS", "SSEE", "SSER")]


def test_compiled_fields_and_fallback(spark):
    compiled = specs.specs_from_frames(fields=spec_rows(spark))
    assert [(r[1], r[2], r[3], r[4], r[7], r[8]) for r in compiled.fields] == [
        ("given_name", "CS", "text", 12, None, "F"), ("birth_date", "SY", "date", 8, "yyyyMMdd", "EE"),
        ("home_postal_code", "Z9", "text", 9, None, "L"),
    ]
    empty = specs.specs_from_frames(fields=spec_rows(spark).filter("false"), tax=specs.tax_spec_from_feed(feed_rows(spark, []), spec_rows(spark)))
    assert empty == specs.default_specs()


def test_feed_reader(spark, tmp_path):
    (tmp_path / "feed.json").write_text('{"taxCode": {"code": "FIT"}, "fieldCode": {"code": "EJ"}, "token": {"code": "QTDT"}}\n{"taxCode": {}}\n')
    got = feed.read_feed(spark, str(tmp_path)).orderBy("seq").collect()
    assert [tuple(r)[1:] for r in got] == [("FIT", "EJ", "QTDT"), (None, None, None)]


def test_feed_lines_of_no_use_are_kept_with_a_reason(spark, tmp_path):
    good = '{"taxCode": {"code": "FIT"}, "fieldCode": {"code": "EJ"}, "token": {"code": "QTDT"}, "other": [1]}'
    lines = {
        good: None,
        good[:-2]: "malformed",
        "{}": "no taxCode",
        '{"taxCode": "FIT", "fieldCode": {"code": "EJ"}, "token": {"code": "QTDT"}}': "malformed",
        "null": "malformed",
        '{"taxCode": {"code": "FIT"}, "fieldCode": null, "token": {"code": "QTDT"}}': "no fieldCode",
        '{"taxCode": {"code": "FIT"}, "fieldCode": {"code": "EJ"}, "token": {"code": ""}}': "no token",
        "   ": "empty",
        "\u00e4": "malformed",
    }
    (tmp_path / "feed.json").write_text("\n".join(lines) + "\n")
    found = feed.checked(feed.read_lines(spark, str(tmp_path)))
    assert {r["value"]: r["reason"] for r in found.collect()} == lines
    bad = feed.rejects(found)
    assert bad.columns == ["seq", "file", "value", "reason"] and bad.count() == len(lines) - 1
    assert all(r["file"].endswith("feed.json") for r in bad.collect())
    assert [tuple(r)[1:] for r in feed.accepted(found).collect()] == [("FIT", "EJ", "QTDT")]
    # Other key names, and an empty feed.
    other = spark.createDataFrame([(1, '{"a": {"code": "x"}, "b": {"code": "y"}}')], "seq bigint, value string")
    assert feed.checked(other, keys=("a", "b", "c")).first()["reason"] == "no c"
    assert feed.rejects(feed.checked(other.limit(0))).count() == 0


def test_loader_checks_and_casts(spark):
    with pytest.raises(ValueError, match="misses columns"):
        schemas.conform(spark.range(1), schemas.PROFILE, "profile")
    df = spark.createDataFrame([("", "", "S", 1, "B", "C")], "state_code string, local_code string, site_id string, organization_unit_sk int, branch_code string, company_code string")
    org = schemas.conform(df, schemas.ORGANIZATION, "organization")
    assert org.schema["organization_unit_sk"].dataType.simpleString() == "bigint"
    assert org.first()["state_code"] == ""


def test_status_normalization(spark):
    df = spark.createDataFrame([("queued",), ("Failed_Generation",), ("done",), (None,)], "status string")
    assert [tuple(r) for r in queue.normalize_status(df).select("status", "is_valid").collect()] == [
        ("QUEUED", True), ("FAILED_GENERATION", True), (None, False), (None, False)]


def test_file_message_is_cut(spark):
    df = spark.createDataFrame([("x" * 3000,)], "m string")
    assert len(df.select(queue.failure_message(F.col("m"))).first()[0]) == 2000


def test_resolution_priority_and_fail_open(spark):
    book = errors.default_rules()
    columns = "company_error_sk bigint, organization_unit_sk bigint, error_code string, resolution_status string, write_status string, state_code string, local_code string, tax_type string, worker_sk bigint"
    rows = [
        (1, 227, "FEIN_IS_MISSING", "Open", "PENDING", None, None, None, None),
        (2, 227, "FEIN_NOT_CORRECT", "Open", "PENDING", None, None, None, None),
        (3, 227, "NEW_UNKNOWN_ERROR", "Open", "PENDING", None, None, None, None),
        (4, 227, "CA_WAGE_PLAN_MISSING", "Open", "PENDING", "CA", None, "SIT", None),
        (5, 227, "SSN_NON_NUM", "Open", "PENDING", None, None, None, 362),
        (6, 227, "SSN_F3_0", "Open", "PENDING", None, None, None, 362),
        (7, 227, "FEIN_IS_MISSING", "Resolved", "PENDING", None, None, None, None),
        (8, 227, "FEIN_IS_MISSING", "Open", "WRITTEN", None, None, None, None),
    ]
    org = spark.createDataFrame([(227, "ST", "C059", "S059")], schemas.ORGANIZATION)
    got = {
        r["company_error_sk"]: (r["resolved_category"], r["scope"], r["unmapped"], r["jurisdiction"])
        for r in errors.decide(spark.createDataFrame(rows, columns), errors.default_catalog(spark), org, "2026-01-15", book).collect()
    }
    assert got == {
        1: ("COMPANY_TAX_ID_ERROR", "SKIP_COMPANY_TAX_OUTPUT", False, None),
        2: ("NO_IMPACT_ERROR", "NO_SKIP", False, None),
        3: ("UNKNOWN", "NO_SKIP", True, None),
        4: ("WAGE_PLAN_ERROR", "SKIP_TAX_JURISDICTION", False, "CA"),
        5: ("EMPLOYEE_PROFILE_ERROR", "SKIP_ENTIRE_EMPLOYEE", False, None),
        6: ("NO_IMPACT_ERROR", "NO_SKIP", False, None),
    }


def test_specification_tables_must_be_small(spark):
    with pytest.raises(ValueError, match="not a specification"):
        sizing.collect_bounded(spark.range(50), 10, "rules")
