"""Packing of a field sequence that is too long for one task.

Greedy packing is sequential: where a line breaks depends on everything before
it.  But the only thing carried from one field to the next is the length of the
open line, a number up to the line width.  So a sequence can be cut into
segments, each segment turned into a table "open length on entry -> lines
closed, open length on exit", the small tables composed in order, and every
segment then packed on its own from its true entry length.

Input rows: the group keys, ``chunk`` and the order columns, ``prefix`` and
``fields``.  Rows of a chunk are bounded by the range partitioning that made it.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quartermill.session import stage
from quartermill.specs.fixed_values import LINE_WIDTH, PREFIX_WIDTH

CHUNK_ROWS = 50_000
PACKET_LINES = 1_000
# Copies of one row made at a time when equal rows are written out again.
COPIES_STEP = 1_000


def ordered_chunks(rows: DataFrame, group: list[str], order: list[str], row_count: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with the id of an order-contiguous chunk, staged.

    Equal rows are merged first and numbered as copies, so that even a group of
    identical rows can be split.  The chunk id becomes data when written, which
    makes it stable whatever is recomputed later.
    """
    columns = rows.columns
    merged = rows.groupBy(*columns).agg(F.count("*").alias("copies"))
    steps = merged.withColumn("step", F.expr(f"explode(sequence(0L, (copies - 1) div {COPIES_STEP}))")).repartition(
        *group, "step"
    )
    copies = steps.withColumn(
        "copy", F.expr(f"explode(sequence(step * {COPIES_STEP}, least(copies, (step + 1) * {COPIES_STEP}) - 1))")
    ).select(*columns, "copy")
    chunks = max(1, -(-row_count // chunk_rows))
    ranged = copies.repartitionByRange(chunks, *group, *order, "copy")
    return stage(ranged.withColumn("chunk", F.spark_partition_id()), "chunks")


# The functions below are nested so that they travel to the tasks by value.


def _transition(keys: list[str], order: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        length = np.arange(LINE_WIDTH + 1)
        closed = np.zeros(LINE_WIDTH + 1, dtype=np.int64)
        for size in [len(text) for row in pdf["fields"] for text in row if text]:
            breaks = (length > 0) & (length + size > LINE_WIDTH)
            closed += breaks
            length = np.where(breaks | (length == 0), PREFIX_WIDTH + size, length + size)
            # A full line and an overlong one both break at the next field.
            length = np.minimum(length, LINE_WIDTH)
        out = pdf[keys].iloc[:1].copy()
        out["exits"] = [length.tolist()]
        out["closed"] = [closed.tolist()]
        return out

    return run


def _compose(keys: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        entry, line, entries, lines = 0, 0, [], []
        for exits, closed in zip(pdf["exits"], pdf["closed"]):
            entries.append(entry)
            lines.append(line)
            entry, line = int(exits[entry]), line + int(closed[entry])
        return pdf[keys].assign(entry=entries, first_line=lines)

    return run


def _pieces(keys: list[str], order: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        length, line = int(pdf["entry"].iloc[0]), int(pdf["first_line"].iloc[0])
        prefix = pdf["prefix"].iloc[0]
        done: list[tuple[int, str]] = []
        parts: list[str] = []
        for row in pdf["fields"]:
            for text in row:
                if not text:
                    continue
                if length and length + len(text) > LINE_WIDTH:
                    if parts:
                        done.append((line, "".join(parts)))
                    line, length, parts = line + 1, 0, []
                if not length:
                    parts, length = [prefix], PREFIX_WIDTH
                parts.append(text)
                length += len(text)
        if parts:
            done.append((line, "".join(parts)))
        out = pd.DataFrame(done, columns=["line", "piece"])
        for key in keys:
            out[key] = pdf[key].iloc[0]
        return out[[*keys, "line", "piece"]]

    return run


def packed_lines(chunked: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Lines per group: ``group.., line, value``, lines counted from 0 in each group."""
    keys = [*group, "chunk"]
    by = [*order, "copy"]
    types = dict(chunked.dtypes)
    key_schema = ", ".join(f"{k} {types[k]}" for k in keys)
    tables = chunked.groupBy(*keys).applyInPandas(
        _transition(keys, by), f"{key_schema}, exits array<bigint>, closed array<bigint>"
    )
    # One small table per chunk of a group meets here, not the group's rows.
    entries = tables.groupBy(*group).applyInPandas(_compose(keys), f"{key_schema}, entry bigint, first_line bigint")
    pieces = (
        chunked.join(stage(entries, "entries"), keys)
        .groupBy(*keys)
        .applyInPandas(_pieces(keys, by), f"{key_schema}, line bigint, piece string")
    )
    # Only a line that crosses chunks has more than one piece.
    whole = F.expr("array_join(transform(array_sort(collect_list(struct(chunk, piece))), p -> p.piece), '')")
    return pieces.groupBy(*group, "line").agg(whole.alias("value"))


def positioned_fields(chunked: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Fields with their position in the group: ``group.., seq, text``.

    Field counts are summed per chunk, accumulated over the few chunks of a
    group, and only inside a chunk row by row.
    """
    in_chunk = Window.partitionBy(*group, "chunk").orderBy(*order, "copy").rowsBetween(Window.unboundedPreceding, -1)
    over_chunks = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*group, "chunk")
        .agg(F.sum(F.size("fields")).alias("n"))
        .select(*group, "chunk", F.coalesce(F.sum("n").over(over_chunks), F.lit(0)).alias("offset"))
    )
    return (
        chunked.withColumn("before", F.coalesce(F.sum(F.size("fields")).over(in_chunk), F.lit(0)))
        .join(offsets, [*group, "chunk"])
        .select(*group, "offset", "before", F.posexplode("fields").alias("pos", "text"))
        .select(*group, (F.col("offset") + F.col("before") + F.col("pos")).alias("seq"), "text")
    )


def line_packets(lines: DataFrame, group: list[str], packet_lines: int = PACKET_LINES) -> DataFrame:
    """Runs of at most ``packet_lines`` lines: ``group.., block, n_lines, lines``."""
    ordered = F.expr("transform(array_sort(collect_list(struct(line, value))), l -> l.value)")
    return (
        lines.withColumn("block", F.expr(f"line div {packet_lines}"))
        .groupBy(*group, "block")
        .agg(ordered.alias("lines"))
        .withColumn("n_lines", F.size("lines"))
    )
