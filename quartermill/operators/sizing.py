"""Size checks that decide between physical strategies."""

from pyspark.sql import DataFrame, functions as F

# Rows of a key table that may be kept as a local relation.
LOCAL_ROWS = 10_000
# Rows of one worker that a single task may gather; packing 160,000 rows takes about two seconds.
WORKER_ROWS = 200_000


def local_if_small(df: DataFrame, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """A key table that several joins use, computed once when it is small.

    Fetches at most ``max_rows + 1`` rows.  If they are all, the result is a
    local relation: never recomputed, and its exact size known to Catalyst.
    """
    rows = df.limit(max_rows + 1).toArrow()
    return df.sparkSession.createDataFrame(rows) if rows.num_rows <= max_rows else df


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a specification table; refuse one that is not small."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} holds more than {max_rows} rows; it is not a specification table")
    return rows


def hot_workers(*tables: DataFrame, row_limit: int = WORKER_ROWS) -> DataFrame | None:
    """Workers with more than ``row_limit`` rows over all ``tables``, or None.

    Counts one column, combined on the map side, once: the result is a local
    table.  There are at most ``rows / row_limit`` such workers.
    """
    keys = tables[0].select("worker_sk")
    for table in tables[1:]:
        keys = keys.unionAll(table.select("worker_sk"))
    counts = keys.groupBy("worker_sk").agg(F.count("*").alias("n")).filter(F.col("n") > row_limit)
    hot = local_if_small(counts.select("worker_sk"))
    return None if hot.isEmpty() else hot
