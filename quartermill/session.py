"""Session settings and staging of intermediate tables."""

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: The largest method, in bytes of code, that HotSpot compiles. A tax row's stage would be one larger method, interpreted for every row.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", "8000"


def compiled(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run`` (spark, ..) in a session whose stages are cut where their code gets too large to be compiled.

    A limit that the session already has stays.
    """

    @wraps(run)
    def limited(spark: SparkSession, *args, **options) -> DataFrame:
        if spark.conf.get(METHOD_LIMIT[0], None) is None:
            spark.conf.set(*METHOD_LIMIT)
        return run(spark, *args, **options)

    return limited


def build_session(name: str = "quartermill", master: str | None = None, **settings) -> SparkSession:
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(*METHOD_LIMIT)
        # Call-site capture costs two gateway calls per column function.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def values_frame(spark: SparkSession, schema: pa.Schema, rows) -> DataFrame:
    """A literal table.

    Built through Arrow it becomes a local relation, so Catalyst knows its
    exact size and broadcasts it only while that size is under the threshold.
    """
    columns = list(zip(*rows)) or [[] for _ in schema]
    return spark.createDataFrame(
        pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, columns)}, schema=schema)
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="quartermill-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is read several times: readers pick only the columns
    they need, and a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def remove_staged(spark: SparkSession) -> int:
    """Delete the tables that ``stage`` wrote in this process; call it when a job's results are stored."""
    removed = 0
    while _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed
