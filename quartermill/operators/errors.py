"""Errors: classification, category resolution, skip scopes."""

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quartermill.functions.text import impact_flag, jurisdiction, normalize_category
from quartermill.session import values_frame
from quartermill.specs import fixed_values as fixed

_TEXT = pa.string()


def catalog_rows() -> list[tuple]:
    return [
        (code, legacy, kind, category, deposit == "Y", filing == "Y")
        for code, legacy, kind, category, deposit, filing in fixed.table(fixed.ERROR_CATALOG)
    ]


_CATALOG_SCHEMA = pa.schema(
    [
        ("error_code", _TEXT), ("legacy_error_code", _TEXT), ("error_type", _TEXT), ("category", _TEXT),
        ("impacts_deposit", pa.bool_()), ("impacts_filing", pa.bool_()),
    ]
)


def default_catalog(spark: SparkSession) -> DataFrame:
    return values_frame(spark, _CATALOG_SCHEMA, catalog_rows())


def versioned_catalog(spark: SparkSession, versions: tuple = ()) -> DataFrame:
    """The built-in catalog with ``effective_from``: empty for its own rows, and further (row, time) ``versions``."""
    schema = pa.schema([*_CATALOG_SCHEMA, ("effective_from", _TEXT)])
    rows = [(*row, None) for row in catalog_rows()] + [(*row, time) for row, time in versions]
    return values_frame(spark, schema, rows).withColumn("effective_from", F.to_timestamp("effective_from"))


def classify(errors: DataFrame, category: str = "category") -> DataFrame:
    """Adds normalised category, processing area, presentation scope and rationale."""
    classes = values_frame(
        errors.sparkSession,
        pa.schema([(n, _TEXT) for n in ("normalized_category", "area", "scope", "why")]),
        fixed.CATEGORY_CLASSES,
    )
    return (
        errors.withColumn("normalized_category", normalize_category(F.col(category)))
        .join(classes, "normalized_category", "left")
        .select(
            *errors.columns,
            "normalized_category",
            F.coalesce("area", F.lit("UNKNOWN")).alias("processing_area"),
            F.coalesce("scope", F.lit("UNKNOWN")).alias("presentation_scope"),
            F.coalesce("why", F.lit(fixed.UNCLASSIFIED_RATIONALE)).alias("rationale"),
        )
    )


def catalog_spans(catalog: DataFrame) -> DataFrame:
    """Catalog rows with the span in which each counts: ``effective_from`` up to, but not at, ``effective_to``.

    A row without ``effective_from`` counts from the beginning. Of several rows
    of one code and time the one that sorts last counts. Only catalog rows meet
    in a window, never errors.
    """
    facts = ["error_type", "category", "impacts_deposit", "impacts_filing"]
    one = catalog.groupBy("error_code", "effective_from").agg(F.max(F.struct(*facts)).alias("fact"))
    later = Window.partitionBy("error_code").orderBy(F.col("effective_from").asc_nulls_first())
    return one.select("error_code", "fact.*", "effective_from", F.lead("effective_from").over(later).alias("effective_to"))


def active_errors(errors: DataFrame, catalog: DataFrame) -> DataFrame:
    """Open and pending errors with their catalog row, if there is one.

    A catalog with ``effective_from`` is read as of each error's
    ``created_date_time``: an equality join with a condition on spans that
    don't overlap, so an error has one row at most however many versions and
    repeats its code has. An error without a date takes the newest version.
    """
    versioned = "effective_from" in catalog.columns
    if versioned:
        catalog = catalog_spans(catalog)
    facts = catalog.select(
        "error_code",
        "error_type",
        "category",
        impact_flag(F.col("impacts_deposit")).alias("impacts_deposit"),
        impact_flag(F.col("impacts_filing")).alias("impacts_filing"),
        F.lit(True).alias("in_catalog"),
        *(["effective_from", "effective_to"] if versioned else []),
    )
    wanted = errors.filter("resolution_status = 'Open' AND write_status = 'PENDING'").select(
        "company_error_sk", "organization_unit_sk", "error_code", "state_code", "local_code", "tax_type", "worker_sk",
        *(["created_date_time"] if versioned else []),
    )
    if not versioned:
        return wanted.join(facts, "error_code", "left").withColumn("in_catalog", F.coalesce("in_catalog", F.lit(False)))
    facts = facts.withColumnRenamed("error_code", "catalog_code")
    at_time = """error_code = catalog_code
        AND (effective_from IS NULL OR created_date_time IS NULL OR created_date_time >= effective_from)
        AND (effective_to IS NULL OR created_date_time < effective_to)"""
    found = wanted.join(facts, F.expr(at_time), "left").withColumn("in_catalog", F.coalesce("in_catalog", F.lit(False)))
    return found.drop("catalog_code", "effective_to", "created_date_time")


def catalog_profile(rows: DataFrame) -> DataFrame:
    """Catalog rows, distinct codes and repeats by category."""
    return (
        rows.groupBy("category", "error_code")
        .agg(F.count("*").alias("n"))
        .groupBy("category")
        .agg(
            F.sum("n").alias("row_count"),
            F.count("*").alias("code_count"),
            F.sum(F.col("n") - 1).alias("repeat_count"),
        )
    )


@dataclass(frozen=True)
class RuleBook:
    """Which category an error resolves to, and what a category skips.

    ``mappings``: (source CODE, CATEGORY or TYPE, key, resolved category).
    ``rules``: (rule id, resolved category, scope, codes, active from, active to);
    dates are ISO text or None for no limit.
    """

    mappings: tuple
    rules: tuple

    def mapping_frame(self, spark: SparkSession, source: str, key: str) -> DataFrame:
        rows = [(k, category) for s, k, category in self.mappings if s == source]
        return values_frame(spark, pa.schema([(key, _TEXT), (f"{source.lower()}_result", _TEXT)]), rows)

    def rule_frame(self, spark: SparkSession) -> DataFrame:
        schema = pa.schema(
            [
                ("rule_id", pa.int32()), ("resolved_category", _TEXT), ("scope", _TEXT),
                ("codes", pa.list_(_TEXT)), ("active_from", _TEXT), ("active_to", _TEXT),
            ]
        )
        return values_frame(spark, schema, self.rules)


DEFAULT_MAPPINGS = (
    ("CODE", "SSN_NON_NUM", "EMPLOYEE_PROFILE_ERROR"),
    ("CODE", "FIT_QTD_INVALID", "SPECIFIC_TAX_CODE_ERROR"),
    ("CATEGORY", "REGISTRATION", "COMPANY_TAX_ID_ERROR"),
    ("CATEGORY", "WAGEPLAN", "WAGE_PLAN_ERROR"),
    ("TYPE", "SSN", "EMPLOYEE_PROFILE_ERROR"),
    ("TYPE", "TAX_ID", "COMPANY_TAX_ID_ERROR"),
)
DEFAULT_RULES = (
    (1, "NO_IMPACT_ERROR", "NO_SKIP", [], None, None),
    (2, "SPECIFIC_TAX_CODE_ERROR", "SKIP_CODE", ["EJ", "CS"], None, None),
    (3, "WAGE_PLAN_ERROR", "SKIP_TAX_JURISDICTION", [], "2020-01-01", None),
    (4, "EMPLOYEE_PROFILE_ERROR", "SKIP_ENTIRE_EMPLOYEE", [], None, None),
    (5, "COMPANY_TAX_ID_ERROR", "SKIP_COMPANY_TAX_OUTPUT", [], None, "2035-12-31"),
    (6, "COMPANY_TAX_ID_ERROR", "SKIP_COMPANY_OUTPUT", [], None, "2019-12-31"),
)


def default_rules() -> RuleBook:
    return RuleBook(DEFAULT_MAPPINGS, DEFAULT_RULES)


def resolve_category(active: DataFrame, book: RuleBook) -> DataFrame:
    """Resolved category and its source: rule, catalog category, error type, impact flags."""
    spark = active.sparkSession
    return (
        active.withColumn("category_key", normalize_category(F.col("category")))
        .join(book.mapping_frame(spark, "CODE", "error_code"), "error_code", "left")
        .join(book.mapping_frame(spark, "CATEGORY", "category_key"), "category_key", "left")
        .join(book.mapping_frame(spark, "TYPE", "error_type"), "error_type", "left")
        .selectExpr(
            *active.columns,
            """coalesce(code_result, category_result, type_result,
                 CASE WHEN NOT in_catalog THEN 'UNKNOWN' WHEN impacts_deposit OR impacts_filing THEN 'IMPACT_ERROR'
                      ELSE 'NO_IMPACT_ERROR' END) AS resolved_category""",
            """CASE WHEN code_result IS NOT NULL THEN 'RULE' WHEN category_result IS NOT NULL THEN 'CATEGORY'
                    WHEN type_result IS NOT NULL THEN 'TYPE' WHEN in_catalog THEN 'IMPACT' ELSE 'NONE' END AS resolved_by""",
        )
    )


def _muted(resolved: DataFrame) -> DataFrame:
    """An error without impact on deposit or filing skips nothing unless a rule names its code."""
    return resolved.withColumn(
        "resolved_category",
        F.expr(
            "CASE WHEN in_catalog AND NOT impacts_deposit AND NOT impacts_filing AND resolved_by <> 'RULE' "
            "THEN 'NO_IMPACT_ERROR' ELSE resolved_category END"
        ),
    )


def _decision_columns() -> list[str]:
    rank = " ".join(f"WHEN '{scope}' THEN {i}" for i, scope in enumerate(fixed.SKIP_SCOPES, 1))
    return [
        "company_error_sk", "error_code", "resolved_category", "rule_id",
        "coalesce(scope, 'NO_SKIP') AS scope",
        "rule_id IS NULL AS unmapped",
        f"CASE coalesce(scope, 'NO_SKIP') {rank} END AS scope_rank",
        "branch_code", "company_code", "worker_sk",
        f"CASE WHEN scope = 'SKIP_TAX_JURISDICTION' OR state_code IS NOT NULL "
        f"THEN {jurisdiction('state_code', 'local_code')} END AS jurisdiction",
        "tax_type",
        "coalesce(codes, CAST(array() AS ARRAY<STRING>)) AS codes",
    ]


def resolve_scopes(resolved: DataFrame, book: RuleBook, organization: DataFrame, as_of: str) -> DataFrame:
    """One decision per error and active rule of its category.

    An error without impact on deposit or filing skips nothing unless a rule
    names its code.  A category without a rule skips nothing and is marked
    ``unmapped``.  State and local code give the jurisdiction the same way as on
    tax rows; without a worker the decision is for the whole company.
    """
    day = f"DATE '{as_of}'"
    active_rules = book.rule_frame(resolved.sparkSession).filter(
        f"coalesce(CAST(active_from AS DATE), {day}) <= {day} AND coalesce(CAST(active_to AS DATE), {day}) >= {day}"
    ).select("rule_id", "resolved_category", "scope", "codes")
    companies = organization.select("organization_unit_sk", "branch_code", "company_code").distinct()
    return (
        _muted(resolved).join(active_rules, "resolved_category", "left")
        .join(companies, "organization_unit_sk", "left")
        .selectExpr(*_decision_columns())
    )


#: Columns of a rule table; a null side is BOTH, a null date is no limit, a null ``active`` is true.
RULE_TABLE = """rule_id INT, resolved_category STRING, side STRING, scope STRING, target STRING, codes ARRAY<STRING>,
    reporting_group STRING, needs_place BOOLEAN, active BOOLEAN, effective_from DATE, effective_to DATE"""


def resolve_by_table(
    resolved: DataFrame, errors: DataFrame, rules: DataFrame | None, organization: DataFrame, group_codes: DataFrame | None = None
) -> DataFrame:
    """``resolve_scopes`` with rules from a table (``RULE_TABLE``), in force on the day of each error; adds side and target.

    ``side`` WORKER or TAX limits a code rule to worker fields or to fields of
    tax rows. A rule with a ``reporting_group`` skips that group's codes of
    ``group_codes`` (reporting_group, code) too. A rule that ``needs_place``
    is for errors with a state only. An error without a date meets rules
    without limits. Without a rule table nothing is skipped, and every error is
    marked ``unmapped``.
    """
    spark = resolved.sparkSession
    rules = spark.createDataFrame([], RULE_TABLE) if rules is None else rules
    groups = spark.createDataFrame([], "reporting_group STRING, code STRING") if group_codes is None else group_codes
    listed = groups.groupBy("reporting_group").agg(F.collect_set("code").alias("group_list"))
    rules = rules.where("coalesce(active, true)").join(listed, "reporting_group", "left")
    rules = rules.selectExpr(
        "rule_id", "resolved_category AS rule_category", "coalesce(upper(side), 'BOTH') AS side",
        "CASE WHEN reporting_group IS NOT NULL THEN 'SKIP_CODE' ELSE scope END AS scope", "target",
        "array_sort(array_distinct(concat(coalesce(codes, array()), coalesce(group_list, array())))) AS codes",
        "coalesce(needs_place, false) AS needs_place", "effective_from", "effective_to",
    )
    raised = errors.select("company_error_sk", F.to_date("created_date_time").alias("raised_on"))
    companies = organization.select("organization_unit_sk", "branch_code", "company_code").distinct()
    in_force = """resolved_category = rule_category AND (NOT needs_place OR state_code IS NOT NULL)
        AND (effective_from IS NULL OR effective_from <= raised_on) AND (effective_to IS NULL OR effective_to >= raised_on)"""
    return (
        _muted(resolved).join(raised, "company_error_sk", "left").join(rules, F.expr(in_force), "left")
        .join(companies, "organization_unit_sk", "left")
        .selectExpr(*_decision_columns(), "coalesce(side, 'BOTH') AS side", "target")
    )


def decide(errors: DataFrame, catalog: DataFrame, organization: DataFrame, as_of: str, book: RuleBook | None = None) -> DataFrame:
    """Errors -> skip decisions."""
    book = book or default_rules()
    return resolve_scopes(resolve_category(active_errors(errors, catalog), book), book, organization, as_of)
