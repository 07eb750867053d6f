"""Employee and tax lines of all queued workers in one plan.

Everything of a worker meets in one partition.  The tax snapshot, the tax
profile and the worker tables are each shuffled once, by ``worker_sk``; the
latest-run rank, the profile join, the grouping per period and the worker join
then run without another exchange.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quartermill.functions import packing
from quartermill.functions.formats import quote
from quartermill.functions.text import jurisdiction_class, jurisdiction_key, jurisdiction_order
from quartermill.operators import mandatory, taxes, workers
from quartermill.operators.sizing import local_if_small
from quartermill.specs.compile import Specs
from quartermill.specs.fixed_values import FEDERAL, JURISDICTION_WIDTH

ARRAY_KEYS = ("worker_sk", "branch_code", "company_code", "site_id")


@dataclass(frozen=True)
class Inputs:
    worker: DataFrame
    address: DataFrame
    snapshot: DataFrame
    profile: DataFrame
    organization: DataFrame
    queue: DataFrame


def site_workers(inputs: Inputs, sites: DataFrame) -> DataFrame:
    """Workers of the queued sites, with their site."""
    companies = local_if_small(
        inputs.organization.select("branch_code", "company_code", "site_id")
        .distinct()
        .join(sites, "site_id", "left_semi")
    )
    return inputs.worker.join(companies, ["branch_code", "company_code"])


def worker_arrays(inputs: Inputs, sites: DataFrame, specs: Specs, decisions=None) -> DataFrame:
    """Per worker: site, company, employee lines, the F, S and L fields, skip decisions.

    Employee lines do not depend on the period, so they are packed here once.
    """
    profile = workers.worker_profile(site_workers(inputs, sites), inputs.address)
    arrays = workers.level_arrays(profile, specs, ARRAY_KEYS)
    extra = []
    if decisions:
        arrays = decisions.attach(arrays)
        extra = list(decisions.COLUMNS)
    own = decisions.kept_fields("ee_fields") if decisions else "ee_fields"
    levels = [f"{level}_fields" for level in "fsl"]
    return arrays.selectExpr(*ARRAY_KEYS, *levels, *extra, f"{own} AS own").selectExpr(
        *ARRAY_KEYS,
        *levels,
        *(f"array_join({level}_fields, '') AS {level}_text" for level in "fsl"),
        *extra,
        f"{packing.worker_lines('own')} AS worker_lines",
    )


def in_periods(snapshot: DataFrame, periods: DataFrame, max_periods: int = 400) -> DataFrame:
    """Snapshot rows of the given years and quarters.

    A few periods become a literal predicate, which prunes partitions and is
    pushed into the scan; more of them are a semi join.  A period without year
    or quarter selects nothing either way.
    """
    wanted = periods.filter("year IS NOT NULL AND quarter IS NOT NULL").select("year", "quarter").distinct()
    rows = wanted.limit(max_periods + 1).collect()
    if len(rows) > max_periods:
        return snapshot.join(wanted, ["year", "quarter"], "left_semi").select(*snapshot.columns)
    years: dict[int, list[int]] = {}
    for year, quarter in sorted(map(tuple, rows)):
        years.setdefault(year, []).append(quarter)
    ranges = [f"(year = {y} AND quarter IN ({', '.join(map(str, qs))}))" for y, qs in years.items()]
    return snapshot.filter(" OR ".join(ranges) or "false")


def period_tax_rows(inputs: Inputs) -> DataFrame:
    """Latest tax rows, partitioned by worker.

    Rows with a NULL strict key rank too: they give no tax line (``complete``
    is false), but they still make their worker part of the period.
    """
    latest = taxes.rank_one(inputs.snapshot.repartition("worker_sk")).withColumn("complete", F.expr(taxes.COMPLETE))
    return taxes.join_profile_by_worker(taxes.with_amounts(latest), inputs.profile)


def coded_tax_rows(rows: DataFrame, specs: Specs) -> DataFrame:
    """One row per tax row: sort keys, coded fields, mandatory codes provided."""
    canonical = taxes.canonical_types(rows, specs).withColumn(
        "covers", F.expr(mandatory.covered_codes(specs))
    )
    kept = (
        "worker_sk", "year", "quarter", "complete", "branch_code", "company_code", "jurisdiction",
        "tax_type", "is_employer_tax", "payroll_run_sk", "covers",
    )
    return taxes.tax_field_arrays(canonical, specs, kept)


SORTED_ROW = f"""named_struct(
    'juris_ord', {jurisdiction_order('jurisdiction')}, 'juris', {jurisdiction_key('jurisdiction')},
    'class', {jurisdiction_class('jurisdiction')}, 'tax_type', tax_type, 'is_employer_tax', is_employer_tax,
    'payroll_run_sk', payroll_run_sk, 'text', array_join(fields, ''), 'fields', fields, 'covers', covers)"""


def _row(juris_ord: str, juris: str, class_: str, tax_type: str, run: int, text: str, fields: str) -> str:
    return (
        f"named_struct('juris_ord', {juris_ord}, 'juris', {juris}, 'class', {class_}, 'tax_type', {tax_type}, "
        f"'is_employer_tax', false, 'payroll_run_sk', {run}L, 'text', {text}, 'fields', {fields}, "
        f"'covers', {packing.NO_LINES})"
    )


def federal_default(tax_type: str, fields: list[str]) -> str:
    """The all-zero row of a mandatory tax type."""
    texts = f"array({', '.join(map(quote, fields))})"
    key = quote(FEDERAL.ljust(JURISDICTION_WIDTH))
    return _row("0", key, "'F'", quote(tax_type), 0, quote("".join(fields)), texts)


def default_tax_rows(rows: str, specs: Specs, blocked=None) -> str:
    """Default rows for the mandatory tax types that ``rows`` do not fully cover.

    ``blocked`` gives the condition under which a skip decision forbids the
    default of a type.
    """
    defaults = []
    for tax_type, fields in taxes.default_row_fields(specs).items():
        absent = " OR ".join(
            f"NOT exists({rows}, r -> array_contains(r.covers, {quote(code)}))"
            for code, (_, code_type) in specs.mandatory().items()
            if code_type == tax_type
        )
        allowed = f" AND NOT {blocked(tax_type)}" if blocked else ""
        defaults.append(f"CASE WHEN ({absent}){allowed} THEN {federal_default(tax_type, fields)} END")
    return f"array_compact(array({', '.join(defaults)}))" if defaults else f"filter({rows}, r -> false)"


def level_rows(rows: str) -> str:
    """Worker fields that ride on each jurisdiction present, ahead of its tax rows."""
    groups = (
        f"array_distinct(transform({rows}, r -> named_struct('juris_ord', r.juris_ord, 'juris', r.juris, 'class', r.class)))"
    )
    pick = "CASE g.class WHEN 'F' THEN f_{0} WHEN 'S' THEN s_{0} ELSE l_{0} END"
    row = _row("g.juris_ord", "g.juris", "g.class", quote(""), -1, pick.format("text"), pick.format("fields"))
    return f"transform({groups}, g -> {row})"


def tax_sets(coded: DataFrame) -> DataFrame:
    """The complete rows of a worker and period as one array, ``tax_set``."""
    # A collected expression is interpreted; the entry, read twice, stays a column and is compiled.
    entries = coded.select("worker_sk", "year", "quarter", F.expr(f"CASE WHEN complete THEN {SORTED_ROW} END AS entry"))
    return entries.groupBy("worker_sk", "year", "quarter").agg(F.expr("collect_list(entry) FILTER (WHERE entry IS NOT NULL) AS tax_set"))


def worker_period_lines(coded: DataFrame, arrays: DataFrame, specs: Specs, decisions=None) -> DataFrame:
    """One row per worker and period with its employee and tax lines."""
    sets = tax_sets(coded)
    joined = sets.join(arrays, "worker_sk")
    rows = decisions.kept_rows("tax_set") if decisions else "tax_set"
    blocked = decisions.blocks_default if decisions else None
    # Steps are columns of their own, so that each array is built once.
    steps = joined.selectExpr(*arrays.columns, "year", "quarter", f"{rows} AS kept")
    steps = steps.selectExpr("*", f"concat(kept, {default_tax_rows('kept', specs, blocked)}) AS taxed")
    if decisions:
        steps = decisions.drop_tax(steps)
    ordered = f"sort_array(concat({level_rows('taxed')}, taxed))"
    if decisions:
        ordered = decisions.kept_codes(ordered)
    return steps.selectExpr(
        *ARRAY_KEYS, "year", "quarter", "worker_lines", f"{ordered} AS ordered"
    ).selectExpr(
        "site_id", "year", "quarter", "branch_code", "company_code", "worker_sk", "0L AS packet", "worker_lines",
        f"{packing.pack_rows('ordered', packing.tax_prefix('r.juris'))} AS tax_lines",
    )


def worker_lines_of(inputs: Inputs, periods: DataFrame, specs: Specs, decisions=None) -> DataFrame:
    """Employee and tax lines per worker and queued period; the snapshot holds those periods."""
    coded = coded_tax_rows(period_tax_rows(inputs), specs)
    arrays = worker_arrays(inputs, periods.select("site_id").distinct(), specs, decisions)
    lines = worker_period_lines(coded, arrays, specs, decisions)
    return lines.join(periods, ["site_id", "year", "quarter"], "left_semi")
