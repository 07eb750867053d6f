"""The filing job: packets of lines, numbered files, outcomes."""

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from quartermill.operators import assembly, queue as queue_ops
from quartermill.operators.sizing import WORKER_ROWS, hot_workers as find_hot, local_if_small
from quartermill.plans import hot_workers
from quartermill.plans.worker_lines import Inputs, in_periods, site_workers, worker_lines_of
from quartermill.session import stage
from quartermill.specs.compile import Specs, default_specs


def _without_hot(inputs: Inputs, hot: DataFrame | None) -> Inputs:
    if hot is None:
        return inputs
    keys = hot
    return replace(
        inputs,
        snapshot=inputs.snapshot.join(keys, "worker_sk", "left_anti"),
        profile=inputs.profile.join(keys, "worker_sk", "left_anti"),
    )


def packets(
    inputs: Inputs,
    specs: Specs | None = None,
    decisions=None,
    hot_row_limit: int = WORKER_ROWS,
) -> DataFrame:
    """Finished lines of every queued file, one packet per worker and period.

    Workers with more than ``hot_row_limit`` snapshot rows are split over many
    tasks and come out as several packets with the same lines.
    """
    specs = specs or default_specs()
    periods = local_if_small(queue_ops.site_periods(inputs.queue))
    inputs = replace(inputs, snapshot=in_periods(inputs.snapshot, periods))
    hot = find_hot(inputs.snapshot, inputs.profile, row_limit=hot_row_limit)
    usual = _without_hot(inputs, hot)
    merged = worker_lines_of(usual, periods, specs, decisions).withColumn("lines", F.concat("worker_lines", "tax_lines")).select(
        *assembly.PACKET, F.size("lines").alias("n_lines"), "lines"
    )
    if hot is None:
        return merged
    return merged.unionByName(hot_workers.packets(inputs, periods, specs, decisions, hot))


def site_file(
    inputs: Inputs, run_time: str, specs: Specs | None = None, decisions=None, tag: str = assembly.DEFAULT_TAG, **options
) -> DataFrame:
    """Numbered lines of all queued files."""
    staged = stage(packets(inputs, specs, decisions, **options), "packets")
    return assembly.numbered_lines(staged, run_time, tag)


def files_with_workers(inputs: Inputs) -> DataFrame:
    """The queued (site, year, quarter) with any worker row, whatever decisions remove later."""
    periods = local_if_small(queue_ops.site_periods(inputs.queue))
    rows = in_periods(inputs.snapshot, periods).select("worker_sk", "year", "quarter").distinct()
    people = site_workers(inputs, periods.select("site_id").distinct()).select("worker_sk", "site_id")
    return rows.join(people, "worker_sk").select(*assembly.FILE).distinct().join(periods, list(assembly.FILE), "left_semi")


def written_sizes(parts: DataFrame) -> DataFrame:
    """Record count of every written file, from its manifest."""
    return parts.groupBy(*assembly.FILE).agg(F.sum("line_count").alias("record_count"))


def results(sizes: DataFrame, periods: DataFrame, unskipped: DataFrame | None = None) -> DataFrame:
    """Outcome per queued file: record count, or why there is none.

    ``sizes``: the record count per file, of what was written (``written_sizes``).
    ``unskipped``: the (site, year, quarter) that have output before skip
    decisions; a file empty only after them counts as skipped.
    """
    out = periods.join(sizes, list(assembly.FILE), "left")
    if unskipped is None:
        return out.withColumn("skipped", F.lit(False))
    had = unskipped.select(*assembly.FILE).distinct().withColumn("had_output", F.lit(True))
    return out.join(had, list(assembly.FILE), "left").selectExpr(
        *assembly.FILE, "record_count", "record_count IS NULL AND coalesce(had_output, false) AS skipped"
    )


def line_rows(inputs: Inputs, specs: Specs | None = None, hot_row_limit: int = WORKER_ROWS) -> tuple[DataFrame, DataFrame]:
    """Employee lines and tax lines of the queued workers, with their position."""
    specs = specs or default_specs()
    periods = local_if_small(queue_ops.site_periods(inputs.queue))
    inputs = replace(inputs, snapshot=in_periods(inputs.snapshot, periods))
    hot = find_hot(inputs.snapshot, inputs.profile, row_limit=hot_row_limit)
    lines = worker_lines_of(_without_hot(inputs, hot), periods, specs)
    keys = [*assembly.FILE, "worker_sk"]
    # For an inner explode the optimizer tests the array's size below the join, and so packs every line twice.
    own, tax = (
        lines.select(*keys, F.posexplode_outer(name).alias("seq", "value")).where("seq IS NOT NULL").withColumn("seq", F.col("seq").cast("bigint"))
        for name in ("worker_lines", "tax_lines")
    )
    if hot is None:
        return own, tax
    packed = hot_workers.packets(inputs, periods, specs, None, hot)
    # Packet 0 holds the employee lines; the tax packets of a worker are few rows.
    before = Window.partitionBy(*keys).orderBy("packet").rowsBetween(Window.unboundedPreceding, -1)
    starts = packed.filter("packet > 0").select(
        *keys, "packet", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("start")
    )
    hot_own = packed.filter("packet = 0").select(*keys, F.posexplode("lines").alias("seq", "value"))
    hot_own = hot_own.withColumn("seq", F.col("seq").cast("bigint"))
    hot_tax = packed.join(starts, [*keys, "packet"]).select(*keys, "start", F.posexplode("lines").alias("pos", "value"))
    return (
        own.unionByName(hot_own),
        tax.unionByName(hot_tax.select(*keys, (F.col("start") + F.col("pos")).alias("seq"), "value")),
    )
