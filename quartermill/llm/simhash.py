"""SimHash near-duplicates: fingerprints, multi-index hashing, groups."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import components
from quartermill.llm.textbatch import Words, blocks
from quartermill.session import stage

BITS = 64
#: A bucket with more fingerprints than this is searched by longer keys.
BUCKET = 256
#: Rows of a group in order: the first one stands for it.
ROW_ORDER = "struct(doc_id is null as no_id, doc_id, text_key)"


def fingerprints_of(texts: pa.Array, words: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash (as signed longs) of every text; a text without words has 0."""
    found = Words(texts, lower=True)
    keep = found.inside.copy()
    gaps = found.ends[found.ends < len(keep)]
    gaps = gaps[~found.inside[gaps]]
    keep[gaps] = True
    data = found.data.copy()
    data[gaps] = 0x20
    place = np.cumsum(keep) - 1
    line = memoryview(data[keep])
    starts, ends = place[found.starts], place[found.ends - 1] + 1
    # The last words of a text start no full shingle; a text that is too short has one of all its words.
    counts = np.where(found.counts >= words, found.counts - words + 1, np.minimum(found.counts, 1))
    owner = np.repeat(np.arange(len(counts)), counts)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = found.first[:-1][owner] + rank
    tail = head + np.minimum(words, found.counts[owner]) - 1
    digest = xxhash.xxh64_intdigest
    bounds = zip(starts[head].tolist(), ends[tail].tolist())
    hashes = np.array([digest(line[a:b], seed) for a, b in bounds], "<u8")
    ones = np.zeros((len(counts), BITS), np.int64)
    filled = np.flatnonzero(counts)
    first = np.cumsum(counts) - counts
    for low in range(0, len(filled), 64):
        some = filled[low : low + 64]
        a, b = first[some[0]], first[some[-1]] + counts[some[-1]]
        for c in range(a, b, 1 << 17):  # a very long text comes in pieces
            d = min(b, c + (1 << 17))
            bits = np.unpackbits(hashes[c:d].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at = np.unique(owner[c:d], return_index=True)
            ones[at[0]] += np.add.reduceat(bits, at[1], axis=0, dtype=np.int64)
    set_bits = 2 * ones > counts[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view("<i8").reshape(-1)


def fingerprint_rows(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp (the fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            fps = pa.array(fingerprints_of(block.column("text"), words))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("text_key"), fps], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("text_key", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_key long, fp long")


def _ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def near_links(fps: DataFrame, distance: int = 3, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints ``fp`` within ``distance`` bits.

    Every fingerprint is stored under the value of each of its segments. As a
    probe it asks, segment by segment, for all values within distance //
    segments bits of its own: of two near fingerprints one segment differs by
    no more. Candidates are then compared on all bits. Probes meet the list of
    filled buckets first, which drops nearly all of them. In a bucket of more
    than ``bucket`` fingerprints, one of the distance + 1 slices of the other
    bits must be equal as well; keys there also hold that slice, which loses no
    pair and splits the bucket.
    """
    width = BITS // segments
    masks = _ball(width, distance // segments)
    ones = (1 << width) - 1

    def part(low: int, size: int):
        return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << size) - 1))

    own = F.array(*[F.struct(F.lit(s).alias("segment"), part(s * width, width).alias("value")) for s in range(segments)])
    stored = fps.select("fp", F.explode(own).alias("k")).select("fp", "k.segment", "k.value")
    filled = stored.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("held"))
    shifts = F.array(*[F.lit(m & ones).cast("long") for m in masks])
    probes = stored.select("fp", "segment", F.explode(F.transform(shifts, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    probes = probes.join(filled, ["segment", "value"])
    stored = stored.join(filled, ["segment", "value"])

    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & (F.col("a") < F.col("b"))

    def meet(keys: list[str], left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.withColumnRenamed("fp", "a"), right.withColumnRenamed("fp", "b")
        condition = near
        for k in keys:
            condition &= left[k] == right[k]
        return left.join(right, condition).select("a", "b")

    few, many = F.col("held") <= bucket, F.col("held") > bucket
    usual = meet(["segment", "value"], probes.where(few).drop("held"), stored.where(few).drop("held"))

    def sliced(rows: DataFrame) -> DataFrame:
        """The other bits of each fingerprint in distance + 1 slices."""
        size = -(-(BITS - width) // (distance + 1))
        # Rotated so that the own segment comes last, the others stand in the low bits.
        turn = ((F.col("segment") + 1) * width) % BITS
        turned = F.expr(f"shiftrightunsigned(fp, cast((segment + 1) * {width} % {BITS} as int))").bitwiseOR(
            F.when(turn == 0, F.lit(0).cast("long")).otherwise(
                F.expr(f"shiftleft(fp, cast({BITS} - (segment + 1) * {width} % {BITS} as int))")
            )
        )
        slices = []
        for n, low in enumerate(range(0, BITS - width, size)):
            bits = min(size, BITS - width - low)
            slices.append(
                F.struct(F.lit(n).alias("slice"), F.shiftrightunsigned(turned, low).bitwiseAND(F.lit((1 << bits) - 1)).alias("piece"))
            )
        rows = rows.where(many).select("fp", "segment", "value", F.explode(F.array(*slices)).alias("k"))
        return rows.select("fp", "segment", "value", "k.slice", "k.piece")

    dense = meet(["segment", "value", "slice", "piece"], sliced(probes), sliced(stored))
    return usual.unionByName(dense).distinct()


def near_groups(docs: DataFrame, distance: int = 3, words: int = 3, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """doc_id, text_key, fp, component_id and first_row of every row.

    ``component_id`` is the smallest doc_id reachable over near links,
    ``first_row`` marks the row that stands for its group: the one of that
    doc_id, of the smallest text_key if several have it.

    Equal fingerprints are one node, so copies never meet each other as pairs.
    Null or empty text: fingerprint 0, linked like any other. Null doc_id:
    takes part after all others; component_id is null only if the whole group
    has no id. Repeated rows stay repeated, and each is marked like the other.
    Empty table: no rows. Other columns are ignored.
    """
    rows = stage(fingerprint_rows(docs, words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min(F.expr(ROW_ORDER)).alias("least")), "nodes")
    return grouped(rows, nodes, near_links(nodes.select("fp"), distance, segments, bucket))


def grouped(rows: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``near_groups`` of ``rows`` (doc_id, text_key, fp) whose nodes (fp, least row) hang together by ``links`` (a, b)."""
    roots = components(links, "a", "b")
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    heads = linked.groupBy("root").agg(F.min("least").alias("head"))
    labels = linked.join(heads, "root").select("fp", "head")
    return rows.join(labels, "fp").select(
        "doc_id",
        "text_key",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))).alias("first_row"),
    )


def hexed(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, distance: int = 3) -> DataFrame:
    """One row of each near-duplicate group, with all columns of ``docs``.

    The row that stands for its group stays. Only keys of the other rows are
    joined; a row repeated with equal doc_id and text stays once.
    """
    return first_rows(docs, near_groups(docs, distance))


def first_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their group in ``groups`` (as of ``near_groups``)."""
    groups = stage(groups, "near-groups")
    lost = groups.where("not first_row").select(F.col("doc_id").alias("lost_id"), F.col("text_key").alias("lost_key")).distinct()
    key = F.xxhash64(docs["text"].cast("string"))
    kept = docs.join(lost, docs["doc_id"].eqNullSafe(lost["lost_id"]) & (key == lost["lost_key"]), "left_anti")
    again = groups.where("first_row").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return kept.select(*docs.columns)
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)
