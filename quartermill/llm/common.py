"""Helpers that several operators share: tables, folds, running totals, components."""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartermill.session import stage

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor))


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality on all ``columns``."""
    condition = left[columns[0]].eqNullSafe(right[columns[0]])
    for name in columns[1:]:
        condition &= left[name].eqNullSafe(right[name])
    return condition


def joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join on ``columns``, nulls equal; the right side's copies of them go."""
    renamed = right.select(*[F.col(c).alias(f"right_{c}" if c in columns else c) for c in right.columns])
    condition = F.lit(True)
    for name in columns:
        condition &= left[name].eqNullSafe(renamed[f"right_{name}"])
    return left.join(renamed, condition, how).drop(*[f"right_{c}" for c in columns])


def block_count(rows: int) -> int:
    """Blocks for ``rows`` rows: with its square root neither the list of blocks nor a block grows fast."""
    return max(1, math.isqrt(rows))


def hash_block(value: Column, blocks: int) -> Column:
    """Block of a 64-bit hash when its whole range is cut into ``blocks`` equal spans, in hash order."""
    return F.floor((F.shiftrightunsigned(value, 32) * F.lit(blocks)) / F.lit(2.0**32)).cast("long")


def running_total(rows: DataFrame, group: list[str], block: str, order: list, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group that come earlier.

    Rows are ordered by ``block``, then ``order`` inside a block. Only block
    totals are accumulated over a whole group; rows only inside their block.
    ``rows`` is read twice, so it should be a written table.
    """
    totals = rows.groupBy(*group, block).agg(F.sum(value).alias("block_total"))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("block_before", F.coalesce(F.sum("block_total").over(before), F.lit(0))).drop("block_total")
    inside = Window.partitionBy(*group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    rows = joined(rows, totals, [*group, block])
    return rows.withColumn(out, F.col("block_before") + F.col("inside_before")).drop("block_before", "inside_before")


def numbered(staged: DataFrame, group: str, out: str) -> DataFrame:
    """Adds ``out``: gapless numbers from 0 within ``group``, in the order of ``place``.

    ``staged`` is a written table whose ``place`` is monotonically_increasing_id()
    and ``part`` the writing partition, so a window never holds more than one
    partition's rows of one group, however large the group is.
    """
    counts = staged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("part_rows"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("part_before", F.coalesce(F.sum("part_rows").over(before), F.lit(0))).drop("part_rows")
    inside = Window.partitionBy(group, "part").orderBy("place")
    rows = staged.withColumn("inside", F.row_number().over(inside) - 1)
    return joined(rows, counts, [group, "part"]).withColumn(out, F.col("part_before") + F.col("inside")).drop("part_before", "inside")


def placed(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` with ``place`` and ``part`` to the shared folder and reads it back."""
    return stage(df.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), name)


def one_row_each(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (with text) joined to the few ``chosen`` ones by ``keys``: the row of the least text hash of each key.

    The least hashes come from an aggregate on keys, so only equal texts of a
    key are left for the last step.
    """
    found = rows.join(F.broadcast(chosen), keys).withColumn("text_hash", F.xxhash64("text"))
    least = found.groupBy(*keys).agg(F.min("text_hash").alias("text_hash"))
    return found.join(F.broadcast(least), [*keys, "text_hash"]).dropDuplicates(keys).drop("text_hash")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components of long nodes: (node, root), root the smallest node; only linked nodes occur.

    Alternates large stars (larger neighbours move to the smallest one) and
    small stars (smaller neighbours do) until the links no longer change. Every
    round is written to the shared folder, so lineage stays short. Only minima
    are gathered for a node, never its neighbours.
    """
    edges = stage(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u > v").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        reached = _state(edges)
        if reached == state:
            break
        state = reached
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first()
    return tuple(row)
