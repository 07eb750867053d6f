"""Workers whose tax rows do not fit one task.

The usual path gathers a worker and period in one row.  For a worker above the
row limit that row could hold a third of the input, so these workers take the
same steps in long form: keyed maxima instead of a rank, joins against small
checked sides, and lines packed segment by segment.  Both paths give the same
lines.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from quartermill.functions import packing
from quartermill.functions.text import jurisdiction_class, jurisdiction_key, jurisdiction_order
from quartermill.operators import assembly, mandatory, segments, taxes
from quartermill.plans import worker_lines
from quartermill.session import stage
from quartermill.specs.compile import Specs

# Packet ids of one jurisdiction of a worker and period.
PACKET_SPAN = 2**40
PERIOD = ["worker_sk", "year", "quarter"]
GROUP = [*PERIOD, "juris_ord", "juris"]
ORDER = ["tax_type", "is_employer_tax", "payroll_run_sk", "text"]


def _rows(inputs: worker_lines.Inputs, specs: Specs) -> DataFrame:
    """Coded tax rows, one per latest tax row."""
    complete = taxes.top_runs(inputs.snapshot).withColumn("complete", F.expr(taxes.COMPLETE))
    rows = taxes.join_profile(taxes.with_amounts(complete), inputs.profile)
    return worker_lines.coded_tax_rows(rows, specs)


def _with_defaults(rows: DataFrame, worker_periods: DataFrame, specs: Specs, decisions) -> DataFrame:
    """Adds the default rows of absent mandatory types; ``rows`` carry worker columns."""
    codes = specs.mandatory()
    has = [F.expr(f"max(array_contains(covers, '{code}')) AS has_{code}") for code in codes]
    seen = rows.groupBy(*PERIOD).agg(*has) if has else rows.select(*PERIOD).distinct()
    candidates = worker_periods.join(seen, PERIOD, "left")
    for tax_type, fields in taxes.default_row_fields(specs).items():
        absent = " OR ".join(f"NOT coalesce(has_{c}, false)" for c, (_, t) in codes.items() if t == tax_type)
        if decisions:
            absent = f"({absent}) AND NOT {decisions.blocks_default(tax_type)}"
        default = candidates.filter(absent).selectExpr(
            *worker_periods.columns, f"inline(array({worker_lines.federal_default(tax_type, fields)}))"
        )
        rows = rows.unionByName(default)
    return rows


def packets(inputs: worker_lines.Inputs, periods: DataFrame, specs: Specs, decisions, hot: DataFrame, chunk_rows: int = segments.CHUNK_ROWS) -> DataFrame:
    """Packets of the hot workers, in the layout of the usual path."""
    keys = hot
    inputs = replace(
        inputs,
        worker=inputs.worker.join(keys, "worker_sk", "left_semi"),
        address=inputs.address.join(keys, "worker_sk", "left_semi"),
        snapshot=inputs.snapshot.join(keys, "worker_sk", "left_semi"),
        profile=inputs.profile.join(keys, "worker_sk", "left_semi"),
    )
    arrays = stage(
        worker_lines.worker_arrays(inputs, periods.select("site_id").distinct(), specs, decisions), "hot-workers"
    )
    coded = stage(_rows(inputs, specs), "hot-rows")
    small_arrays = arrays
    in_queue = periods
    worker_periods = (
        coded.select(*PERIOD).distinct().join(small_arrays, "worker_sk").join(in_queue, ["site_id", "year", "quarter"], "left_semi")
    )
    info = [n for n in arrays.columns if n != "worker_sk"]
    rows = (
        coded.filter("complete")
        .drop("branch_code", "company_code")
        .join(small_arrays, "worker_sk")
        .join(in_queue, ["site_id", "year", "quarter"], "left_semi")
        .selectExpr(
            *PERIOD, *info,
            f"{jurisdiction_order('jurisdiction')} AS juris_ord", f"{jurisdiction_key('jurisdiction')} AS juris",
            f"{jurisdiction_class('jurisdiction')} AS class", "tax_type", "is_employer_tax", "payroll_run_sk",
            "array_join(fields, '') AS text", "fields", "covers",
        )
    )
    if decisions:
        rows = rows.filter(decisions.keeps_row())
    taxed = _with_defaults(rows, worker_periods.select(*PERIOD, *info), specs, decisions)
    if decisions:
        taxed = taxed.filter("NOT skip_tax")
    pick = "CASE class WHEN 'F' THEN f_{0} WHEN 'S' THEN s_{0} ELSE l_{0} END"
    riding = (
        taxed.select(*PERIOD, "juris_ord", "juris", "class")
        .distinct()
        .join(small_arrays, "worker_sk")
        .selectExpr(
            *PERIOD, *info, "juris_ord", "juris", "class", "'' AS tax_type", "false AS is_employer_tax",
            "-1L AS payroll_run_sk", f"{pick.format('text')} AS text", f"{pick.format('fields')} AS fields",
            f"{packing.NO_LINES} AS covers",
        )
    )
    kept = decisions.keeps_codes("fields", "juris") if decisions else "fields"
    sequence = taxed.unionByName(riding).selectExpr(
        *GROUP, *ORDER, f"{packing.tax_prefix('juris')} AS prefix", f"{kept} AS fields"
    )
    chunked = segments.ordered_chunks(sequence, GROUP, ORDER, coded.count(), chunk_rows)
    blocks = segments.line_packets(segments.packed_lines(chunked, GROUP, ORDER), GROUP)
    return _layout(stage(blocks, "hot-packets"), worker_periods)


def _layout(blocks: DataFrame, worker_periods: DataFrame) -> DataFrame:
    """Number the packets of a worker and period: employee lines, then jurisdictions in order."""
    per_juris = blocks.select(*GROUP).distinct()
    place = F.row_number().over(Window.partitionBy(*PERIOD).orderBy("juris_ord", "juris"))
    placed = per_juris.withColumn("place", place)
    company = worker_periods.select(*PERIOD, "site_id", "branch_code", "company_code")
    tax = (
        blocks.join(placed, GROUP)
        .withColumn("packet", F.col("place").cast("bigint") * PACKET_SPAN + F.col("block"))
        .join(company, PERIOD)
    )
    own = worker_periods.selectExpr(
        *PERIOD, "site_id", "branch_code", "company_code", "0L AS packet",
        "size(worker_lines) AS n_lines", "worker_lines AS lines",
    )
    columns = [*assembly.PACKET, "n_lines", "lines"]
    return own.select(*columns).unionByName(tax.select(*columns))
