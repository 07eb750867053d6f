"""File assembly: headers, line numbers, trailer.

A *packet* is a bounded run of finished lines of one worker and period:
``site_id, year, quarter, branch_code, company_code, worker_sk, packet,
n_lines, lines``.  All order in a file follows from its keys.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from quartermill.operators.sizing import local_if_small
from quartermill.session import stage
from quartermill.specs import fixed_values as fixed

FILE = ("site_id", "year", "quarter")
COMPANY = (*FILE, "branch_code", "company_code")
PACKET = (*COMPANY, "worker_sk", "packet")
# Order of packets in a file; ``part`` sets header, body and trailer apart.
PACKET_ORDER = ("part", "branch_code", "company_code", "worker_sk", "packet")
DEFAULT_TAG = "QTRFILINGS"


def file_header(year: Column, quarter: Column, run_time: Column, tag: str = DEFAULT_TAG) -> Column:
    """160 characters: time stamp, ten-character tag, two-digit year and quarter, Q."""
    return F.concat(
        F.repeat(F.lit(" "), F.lit(12)),
        F.date_format(run_time, "yyMMddHHmmss"),
        F.rpad(F.lit(tag), 10, " "),
        F.right(year.cast("string"), F.lit(2)),
        quarter.cast("string"),
        F.repeat(F.lit(" "), F.lit(11)),
        F.rpad(F.lit("Q"), 112, " "),
    )


def company_header(branch_code: Column, company_code: Column) -> Column:
    return F.concat(F.repeat(F.lit(" "), F.lit(6)), branch_code, company_code, F.lit(fixed.COMPANY_SUFFIX))


def company_header_padded(branch_code: Column, company_code: Column) -> Column:
    """The alternative layout: fixed widths for both codes, 160 characters."""
    branch = F.rpad(F.coalesce(branch_code, F.lit("")), 2, " ")
    company = F.rpad(F.coalesce(company_code, F.lit("")), 4, " ")
    return F.rpad(company_header(branch, company), fixed.LINE_WIDTH, " ")


def trailer(line_count: Column) -> Column:
    """The count covers header and trailer; more than seven digits are kept."""
    digits = line_count.cast("string")
    return F.concat(
        F.lit(fixed.TRAILER_MARK), F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits)
    )


def file_sizes(packets: DataFrame) -> DataFrame:
    """Physical lines per file: header, company headers, lines, trailer."""
    return (
        packets.groupBy(*COMPANY)
        .agg(F.sum("n_lines").alias("n"))
        .groupBy(*FILE)
        .agg((F.sum("n") + F.count("*") + 2).alias("record_count"))
    )


def _edges(packets: DataFrame, run_time: str, tag: str) -> tuple[DataFrame, DataFrame]:
    sizes = file_sizes(packets)
    stamp = F.lit(run_time).cast("timestamp")
    header = sizes.select(
        *FILE, F.lit(1).cast("bigint").alias("line_no"), file_header(F.col("year"), F.col("quarter"), stamp, tag).alias("value")
    )
    closing = sizes.select(
        *FILE, F.col("record_count").alias("line_no"), trailer(F.col("record_count")).alias("value")
    )
    return header, closing


def numbering_blocks(packets: DataFrame, run_time: str, tag: str = DEFAULT_TAG) -> DataFrame:
    """All lines in order inside blocks: ``site_id, year, quarter, value, block, place``.

    Blocks are range partitions of whole packets, so they hold about the same
    number of packets however the keys are spread; ``place`` ascends by one in a
    block.  The table is written: range bounds come from a sample, and a block
    must not change between two reads.
    """
    together = ordered_packets(packets, run_time, tag)
    order = [*FILE, *PACKET_ORDER]
    sorted_packets = together.repartitionByRange(*order).sortWithinPartitions(*order)
    lines = sorted_packets.select(*FILE, F.explode("lines").alias("value"))
    return stage(lines.withColumns({"block": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "numbered-lines")


def numbered_lines(packets: DataFrame, run_time: str, tag: str = DEFAULT_TAG) -> DataFrame:
    """All lines of all files with their line number: ``site_id, year, quarter, line_no, value``.

    ``packets`` should be staged: sizes are counted from keys and line counts.
    Lines move once, as whole packets.  Of each file and block only the count and the
    first place are kept; accumulated over a file's blocks they give the shift
    from place to line number, a table of files plus blocks rows, which Catalyst
    broadcasts while it is small.
    """
    lines = numbering_blocks(packets, run_time, tag)
    spans = lines.groupBy(*FILE, "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy(*FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.lit(1) + F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = local_if_small(spans.select(*FILE, "block", shift.alias("shift")))
    return lines.join(shifts, [*FILE, "block"]).select(*FILE, (F.col("place") + F.col("shift")).alias("line_no"), "value")


def ordered_packets(packets: DataFrame, run_time: str, tag: str = DEFAULT_TAG) -> DataFrame:
    """Headers, packets and trailers with sort keys instead of numbers, lines still together, for the sink.

    The sink sorts by these keys anyway, so it needs no numbering pass.
    """
    low, high, none = F.lit(-(2**63)), F.lit(2**63 - 1), F.lit(None).cast("string")
    header, closing = _edges(packets, run_time, tag)

    def one(df: DataFrame, part: int, worker: Column, value: Column, branch: Column = none, company: Column = none) -> DataFrame:
        return df.select(
            *FILE, F.lit(part).alias("part"), branch.alias("branch_code"), company.alias("company_code"), worker.alias("worker_sk"),
            F.lit(0).cast("bigint").alias("packet"), F.array(value).alias("lines"),
        )

    branch, company = F.col("branch_code"), F.col("company_code")
    body = packets.select(*FILE, F.lit(1).alias("part"), branch, company, "worker_sk", F.col("packet").cast("bigint"), "lines")
    headers = one(packets.select(*COMPANY).distinct(), 1, low, company_header(branch, company), branch, company)
    return body.unionByName(headers).unionByName(one(header, 0, low, F.col("value"))).unionByName(one(closing, 2, high, F.col("value")))


def ordered_lines(packets: DataFrame, run_time: str, tag: str = DEFAULT_TAG) -> DataFrame:
    """The same with one row a line and its place ``pos`` in the packet."""
    together = ordered_packets(packets, run_time, tag)
    return together.select(*(c for c in together.columns if c != "lines"), F.posexplode("lines").alias("pos", "value"))
