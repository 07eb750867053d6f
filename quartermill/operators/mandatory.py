"""Mandatory tax fields: coverage, missing workers, default rows."""

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quartermill.functions.formats import quote
from quartermill.functions.packing import NO_LINES
from quartermill.session import values_frame
from quartermill.specs.compile import Specs

PERIOD_KEYS = ("worker_sk", "year", "quarter")
ZERO_MEASURES = (
    "qtd_amount", "qtd_taxable_amount", "qtd_subject_amount", "qtd_gross_wages", "ytd_amount",
    "ytd_taxable_amount", "ytd_subject_amount", "ytd_gross_wages", "tax_rate", "hours_worked",
    "qtd_overtime_amount", "ytd_overtime_amount", "oos_qtd_gross_wages", "oos_ytd_gross_wages",
    "oos_qtd_taxable_amount", "oos_ytd_taxable_amount",
)


def covers(measure: str, tax_type: str) -> str:
    """SQL text: does a (canonical) tax row provide this mandatory field?"""
    same = f"tax_type = {quote(tax_type)}"
    return same if measure == "qtd_amount" else f"({same} AND {measure} IS NOT NULL)"


def covered_codes(specs: Specs) -> str:
    """SQL text: array of the mandatory codes a tax row provides."""
    codes = [f"CASE WHEN {covers(m, t)} THEN {quote(code)} END" for code, (m, t) in specs.mandatory().items()]
    return f"array_compact(array({', '.join(codes)}))" if codes else NO_LINES


def coverage_flags(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    """Per worker and period, one flag per mandatory code, in one aggregation for all codes."""
    flags = [
        F.expr(f"max({covers(measure, tax_type)}) AS has_{code}")
        for code, (measure, tax_type) in specs.mandatory().items()
    ]
    seen = rows.groupBy(*PERIOD_KEYS).agg(*flags)
    return worker_periods.join(seen, list(PERIOD_KEYS), "left").selectExpr(
        *worker_periods.columns, *(f"coalesce(has_{code}, false) AS has_{code}" for code in specs.mandatory())
    )


def _per_code(flags: DataFrame, specs: Specs, keys) -> DataFrame:
    entries = [
        F.struct(
            F.lit(code).alias("code"), F.lit(tax_type).alias("tax_type"), F.col(f"has_{code}").alias("present")
        )
        for code, (_, tax_type) in specs.mandatory().items()
    ]
    return flags.select(*keys, F.inline(F.array(*entries)))


def missing_fields(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    """(worker, period, code, tax type) of every absent mandatory field."""
    flags = coverage_flags(rows, worker_periods, specs)
    return _per_code(flags, specs, PERIOD_KEYS).filter(~F.col("present")).drop("present")


def coverage(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    """Per company, period and code: workers with and without the field."""
    keys = ("branch_code", "company_code", "year", "quarter")
    flags = coverage_flags(rows, worker_periods, specs)
    with_field = F.count_if("present")
    return (
        _per_code(flags, specs, keys)
        .groupBy(*keys, "code", "tax_type")
        .agg(
            F.count("*").alias("total_workers"),
            with_field.alias("workers_with"),
            (F.count("*") - with_field).alias("workers_missing"),
            F.every("present").alias("passed"),
        )
    )


def summary(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    """Per company and period: worker count and overall outcome."""
    keys = ("branch_code", "company_code", "year", "quarter")
    complete = reduce(lambda a, b: a & b, (F.col(f"has_{code}") for code in specs.mandatory()), F.lit(True))
    return (
        coverage_flags(rows, worker_periods, specs)
        .groupBy(*keys)
        .agg(F.count("*").alias("total_workers"), F.count_if(~complete).alias("incomplete_workers"))
        .withColumn(
            "status",
            F.when(F.col("incomplete_workers") == 0, "COMPLETE").otherwise(
                "INCOMPLETE"
            ),
        )
    )


def default_rows(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    """Federal zero rows for the tax types whose mandatory fields are absent.

    One row per worker, period and tax type: it provides every mandatory field
    of that type at once.
    """
    types = dict(rows.dtypes)
    missing = missing_fields(rows, worker_periods, specs).select(*PERIOD_KEYS, "tax_type").distinct()
    columns = []
    for name in rows.columns:
        if name in (*PERIOD_KEYS, "tax_type"):
            column = F.col(name)
        elif name == "jurisdiction":
            column = F.lit("F")
        elif name == "is_employer_tax":
            column = F.lit(False)
        elif name in ZERO_MEASURES:
            column = F.lit(0)
        else:
            column = F.lit(None)
        columns.append(column.cast(types[name]).alias(name))
    return missing.select(*columns)


def backfill(rows: DataFrame, worker_periods: DataFrame, specs: Specs) -> DataFrame:
    return rows.unionByName(default_rows(rows, worker_periods, specs))
