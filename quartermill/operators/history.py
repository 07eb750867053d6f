"""Status history of outbound files: an append-only event table, folded to the present state.

A run writes one GENERATING event per queued file when it starts and one event
with the outcome when it ends.  Events lie in a partition per run and phase; a
repeated run overwrites its own partitions and so changes nothing.  The present
state of a file is a fold of its queue row and its events: one aggregate with
partial results, no join and no window.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quartermill.operators import queue as queue_ops
from quartermill.specs import fixed_values as fixed

KEYS = ("batch_id", *queue_ops.PERIOD)
VALUES = ("record_count", "outbound_file_name", "object_key", "error_message")
EVENT = (
    "batch_id STRING, site_id STRING, year INT, quarter INT, file_type STRING, window_start DATE, window_end DATE, "
    "status STRING, record_count BIGINT, outbound_file_name STRING, object_key STRING, error_message STRING, "
    "event_time TIMESTAMP, run_id STRING, phase STRING"
)
START, END = "start", "end"


def _event(df: DataFrame, run_id: str | None, time: str | None, phase: str) -> DataFrame:
    """``df`` in the columns of EVENT; what it lacks is NULL."""
    own = {"event_time": F.lit(time), "run_id": F.lit(run_id), "phase": F.lit(phase)}
    columns = []
    for entry in EVENT.split(", "):
        name, kind = entry.split()
        value = own.get(name, F.col(name) if name in df.columns else F.lit(None))
        columns.append(value.cast(kind.lower()).alias(name))
    return df.select(*columns)


def started(queue: DataFrame, run_id: str, time: str) -> DataFrame:
    """A GENERATING event for every queued file; also the entry of a file that the queue does not list yet."""
    files = queue_ops.queued(queue).withColumns({"status": F.lit("GENERATING"), "file_type": F.lit(fixed.QUEUE_FILE_TYPE)})
    return _event(files, run_id, time, START)


def ended(changes: DataFrame, entries: DataFrame, run_id: str, time: str) -> DataFrame:
    """The outcome (``queue.status_changes``) of the files that the run has started, ``entries``."""
    own = entries.select(*KEYS).distinct()
    return _event(changes.join(own, list(KEYS), "left_semi"), run_id, time, END)


def write_events(events: DataFrame, path: str) -> None:
    """Add events to the table at ``path``; those that an earlier try of the same run and phase wrote are replaced.

    Read the table anew after a repeated run: its old files are gone.
    """
    writer = events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id", "phase").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).parquet(path)


def _latest(name: str) -> Column:
    """The last value that is set: an event without a value leaves the earlier one."""
    return F.expr(f"max_by(`{name}`, at) FILTER (WHERE `{name}` IS NOT NULL)").alias(name)


def folded(queue: DataFrame, events: DataFrame) -> DataFrame:
    """The present state per file: KEYS, file_type, status, VALUES, attempts, created_at, updated_at.

    The queue row comes first, then events by time; of one time the end of a
    run follows its start.  ``attempts`` counts the runs that started the file,
    ``created_at`` and ``updated_at`` are those of its events.  Files without a
    queue row come from their entry.  Equal events count once, and a NULL key
    is a key like any other.
    """
    base = _event(queue, None, None, "queue")
    rows = base.unionByName(events.select(*base.columns))
    step = F.when(F.col("phase") == START, 1).when(F.col("phase") == END, 2).otherwise(0)
    rows = rows.withColumn("at", F.struct("event_time", step.alias("step"), "run_id"))
    return rows.groupBy(*KEYS).agg(
        *(_latest(name) for name in ("file_type", "status", *VALUES)),
        F.expr(f"size(collect_set(run_id) FILTER (WHERE phase = '{START}'))").cast("bigint").alias("attempts"),
        F.min("event_time").alias("created_at"),
        F.max("event_time").alias("updated_at"),
    )


def unfinished(state: DataFrame, before: str) -> DataFrame:
    """Files that a run started before ``before`` and never ended."""
    return state.filter((F.col("status") == "GENERATING") & (F.col("updated_at") < F.lit(before).cast("timestamp")))


def requeued(state: DataFrame, statuses: tuple[str, ...] = ("FAILED",), most: int = 3) -> DataFrame:
    """Started files of these statuses with fewer than ``most`` attempts, QUEUED again; feed for the next run."""
    again = state.filter(F.col("status").isin(*statuses) & F.col("attempts").between(1, most - 1))
    return again.select(
        *KEYS, F.lit(None).cast("date").alias("window_start"), F.lit(None).cast("date").alias("window_end"),
        F.lit("QUEUED").alias("status"), "file_type",
    )
