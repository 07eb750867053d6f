"""Rendezvous hashing of record keys over weighted shards."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import numbered, placed

SHARDS = 24


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard whose draw ``-ln(u) / weight`` is smallest, u a hash of key and shard number in (0, 1).

    A shard's draws do not depend on the other shards. So a new shard only
    takes keys, and each shard holds its weight's share of them. A null key is
    one key like any other.
    """
    draws = []
    for shard, weight in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(2.0**53)
        draws.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*draws))["shard"]


def shard_rows(
    docs: DataFrame, weights: list[float] | None = None, new_weight: float | None = None, key: str = "doc_id"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Slots number a shard's rows without gaps: rows are counted per input
    partition and shard, the counts accumulated, and rows numbered only within
    their partition, so a shard or key with most of the rows is no hot spot.
    ``grown_shard`` is the shard once another one of ``new_weight`` (the mean
    weight if None) is added.

    Null text: size 8, checksum 0. Null key: all such rows share one shard.
    Repeated rows share a shard and get their own slots. Empty table: no rows.
    Other columns are ignored.
    """
    weights = [1.0] * SHARDS if weights is None else list(weights)
    added = sum(weights) / len(weights) if new_weight is None else new_weight
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, added]).alias("grown_shard"),
    )
    rows = numbered(placed(rows, "shards"), "shard", "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
