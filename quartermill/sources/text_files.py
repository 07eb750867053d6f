"""Ordered text sink: one folder per site and period, parts in line order."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quartermill.operators.assembly import FILE, PACKET_ORDER
from quartermill.schemas import require_columns

ORDER = (*PACKET_ORDER, "pos")
# Lines of a part file: about 16 MB of text.
PART_LINES = 100_000


def arranged(rows: DataFrame, pad_to: int | None = None) -> DataFrame:
    """Lines as the sink writes them: range partitions, sorted inside.

    ``rows`` are packets with their ``lines`` (``assembly.ordered_packets``) or
    single lines.  Packets are shuffled whole and become lines only afterwards,
    so no line carries its keys through the shuffle.
    """
    if "lines" in rows.columns:
        require_columns(rows, [*FILE, *PACKET_ORDER], "packets")
        rows = rows.repartitionByRange(*FILE, *PACKET_ORDER)
        lines = rows.select(*FILE, *PACKET_ORDER, F.posexplode("lines").alias("pos", "value"))
    else:
        require_columns(rows, [*FILE, *ORDER, "value"], "lines")
        lines = rows.repartitionByRange(*FILE, *ORDER)
    value = F.rpad("value", F.greatest(F.length("value"), F.lit(pad_to)), " ") if pad_to else F.col("value")
    return lines.withColumn("value", value).sortWithinPartitions(*FILE, *ORDER).select(*FILE, "value")


def write_site_files(
    rows: DataFrame, path: str, pad_to: int | None = None, compression: str = "none", part_lines: int = PART_LINES
) -> None:
    """Write ordered packets or lines as text, partitioned by site and period.

    Range partitioning splits a large site over many tasks; the part files of a
    folder, taken by number, are in line order.  The sort starts with the folder
    columns, so the writer keeps it.  ``compression``: ``none`` or ``gzip``,
    whose parts, joined by number, are one gzip file.  A part holds at most
    ``part_lines`` lines, so that one task can number it.
    """
    writer = arranged(rows, pad_to).write.mode("overwrite").option("maxRecordsPerFile", part_lines)
    # Lines repeat much of each other: the fast level makes them nearly as small.
    writer.option("zlib.compress.level", "BEST_SPEED").partitionBy(*FILE).text(path, compression=compression)


def part_number(path: Column) -> list[Column]:
    """Order of part files: by number, not by name, whose digits grow beyond five at part 100,000."""
    name = F.element_at(F.split(path, "/"), -1)
    return [F.regexp_extract(name, pattern, 1).try_cast("bigint") for pattern in (r"^part-(\d+)", r"\.c(\d+)\.")] + [path]


def _read(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lines of the part files, or the parts as one value each."""
    schema = "value string, site_id string, year int, quarter int"
    found = spark.read.schema(schema).text(path, wholetext=whole)
    return found.select(*FILE, "value", F.col("_metadata.file_path").alias("part_path"))


def manifest(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The written parts of every file, in order, under the file's registered name.

    ``names``: site, year, quarter, outbound_file_name.  The parts of a file,
    joined by ``part_no``, are the file: ``first_line`` and ``line_count`` tell
    which lines a part holds.
    """
    parts = _read(spark, path).groupBy(*FILE, "part_path").agg(F.count("*").alias("line_count"))
    in_file = Window.partitionBy(*FILE).orderBy(*part_number(F.col("part_path")))
    before = F.sum("line_count").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return (
        parts.withColumn("part_no", F.row_number().over(in_file))
        .withColumn("first_line", F.lit(1) + F.coalesce(before, F.lit(0)))
        .join(names.select(*FILE, "outbound_file_name"), list(FILE), "left")
        .select(*FILE, "outbound_file_name", "part_no", "part_path", "first_line", "line_count")
    )


def read_site_files(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame:
    """All lines of the written files with their line number, which the manifest ``parts`` gives.

    A part is read as one value, which tells the place of each of its lines, so
    lines need no shuffle to be numbered; parts are of bounded size.  The
    manifest, a row for a part, goes to the parts.
    """
    starts = F.broadcast(parts.select("part_path", "first_line", "line_count"))
    whole = _read(spark, path, whole=True).join(starts, "part_path")
    # A single character is split without a pattern, which is many times faster.
    texts = F.when(F.contains("value", F.lit("\r")), F.split("value", r"\r\n|\r|\n")).otherwise(F.split("value", "\n"))
    # For an inner explode the optimizer splits every part once more to test the number of its lines.
    lines = whole.select(*FILE, "first_line", "line_count", F.posexplode_outer(texts).alias("line", "value"))
    # What follows the last line's end is no line.
    return lines.where("line < line_count").select(*FILE, (F.col("first_line") + F.col("line")).alias("line_no"), "value")
