"""Ordered tax fields per worker, period and jurisdiction."""

from pyspark.sql import DataFrame, functions as F

from quartermill.operators import segments

GROUP = ["worker_sk", "year", "quarter", "jurisdiction"]
ORDER = ["tax_type", "is_employer_tax", "payroll_run_sk", "text"]


def ordered_fields(arrays: DataFrame, hot: DataFrame | None = None, chunk_rows: int = segments.CHUNK_ROWS) -> DataFrame:
    """``group.., seq, text`` from one row per tax row with its ``fields``.

    Groups of usual workers are sorted as arrays; those of hot workers are
    numbered over range-partitioned chunks and never gathered.
    """
    rows = arrays.selectExpr(*GROUP, *ORDER[:3], "array_join(fields, '') AS text", "fields")
    usual = rows if hot is None else rows.join(hot, "worker_sk", "left_anti")
    gathered = usual.groupBy(*GROUP).agg(
        F.expr(f"flatten(transform(sort_array(collect_list(struct({', '.join(ORDER)}, fields))), r -> r.fields)) AS fields")
    )
    fields = gathered.select(*GROUP, F.posexplode("fields").alias("seq", "text"))
    fields = fields.withColumn("seq", F.col("seq").cast("bigint"))
    if hot is None:
        return fields
    large = rows.join(hot, "worker_sk", "left_semi")
    chunked = segments.ordered_chunks(large, GROUP, ORDER, large.count(), chunk_rows)
    return fields.unionByName(
        segments.positioned_fields(chunked, GROUP, ORDER)
    )


def merge_levels(fields: DataFrame, groups: DataFrame, arrays: DataFrame) -> DataFrame:
    """Worker fields of a jurisdiction's class ahead of its tax fields.

    ``groups``: one row per group with its ``juris_class``; ``arrays``: the F, S
    and L fields per worker.  Routing by class is a plain equality join, and the
    worker fields shift the tax fields by their number.
    """
    ride = "CASE juris_class WHEN 'F' THEN f_fields WHEN 'S' THEN s_fields ELSE l_fields END"
    riding = groups.join(arrays, "worker_sk", "left").selectExpr(*GROUP, "juris_class", f"coalesce({ride}, array()) AS riding")
    ahead = riding.select(*GROUP, "juris_class", F.posexplode("riding").alias("seq", "text"))
    behind = fields.join(riding, GROUP).selectExpr(*GROUP, "juris_class", "seq + size(riding) AS seq", "text")
    return ahead.withColumn("seq", F.col("seq").cast(dict(behind.dtypes)["seq"])).unionByName(behind)
