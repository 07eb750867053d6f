"""Mixture-controlled packing: deficit round-robin over source queues into fixed windows."""

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import block_count, hash_block, joined, placed, running_total
from quartermill.llm.textbatch import blocks
from quartermill.session import stage

WINDOW, END = 2048, 1
#: An order has the part in its upper and the row in its lower bits; shares of the sources are held in so many spans of it.
ROW_BITS, SPANS = 33, 64
#: A queue sends its documents in packets of at most this many ids.
PACKET = 256
#: The only special string of the vocabulary; texts that hold it take the slower encoder, which gives it its id.
SPECIAL = "<|endoftext|>"


def vocabulary() -> tuple[str, str]:
    """Paths of the vocabulary for ``tokenizers`` and of the same one as ranks."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ranks(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(texts: list[str], paths: tuple[str, str], loaded: dict | None = None) -> list[list[int]]:
    """Ids of whole texts without special tokens added; both encoders hold the same merges.

    ``loaded`` keeps the encoders between calls.
    """
    loaded = {} if loaded is None else loaded
    if "ranks" not in loaded:
        loaded["ranks"] = _ranks(paths[1])
    ranks = loaded["ranks"]
    slow = [i for i, text in enumerate(texts) if SPECIAL in text]
    out = [[] if SPECIAL in text else ranks.encode_ordinary(text) for text in texts]
    if slow:
        if "exact" not in loaded:
            loaded["exact"] = _exact(paths[0])
        found = loaded["exact"].encode_batch([texts[i] for i in slow], add_special_tokens=False)
        for i, ids in zip(slow, found):
            out[i] = ids.ids
    return out


def tokenized(docs: DataFrame, paths: tuple[str, str], end: int = END, order: Column | None = None) -> DataFrame:
    """doc_id, source, rank (the value of ``order``), n (ids with the end) and ids (compressed, two bytes each) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict = {}
        for block in blocks(batches):
            ids = [np.array([*x, end], "<u2") for x in encode(block.column("text").fill_null("").to_pylist(), paths, loaded)]
            packed = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in ids]
            columns = [*[block.column(c) for c in ("doc_id", "source", "rank")], pa.array([len(x) for x in ids], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "rank", "n", "ids"])

    rank = (F.lit(None) if order is None else order).cast("long").alias("rank")
    rows = docs.select(*[F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("source", "string"), ("text", "string"))], rank)
    return rows.mapInArrow(run, "doc_id long, source string, rank long, n long, ids binary")


def row_order(docs: DataFrame) -> Column:
    """The order of the rows as written: number of the part file, then row in it; without files the order of the partitions."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index").schema
    except AnalysisException:
        return F.monotonically_increasing_id()
    part = F.regexp_extract("_metadata.file_path", r"part-(\d+)[^/]*$", 1)
    # Files that a task cuts its part into are numbered at the end of their names.
    file = F.coalesce(F.regexp_extract("_metadata.file_path", r"-c(\d+)[^/]*$", 1).try_cast("long"), F.lit(0))
    part = F.coalesce(part.try_cast("long"), F.lit(0))
    return F.shiftleft(part * 1024 + file, ROW_BITS) + F.col("_metadata.row_index")


def scheduled(queue: DataFrame, weights: dict | None = None, window: int = WINDOW, packet: int = PACKET) -> DataFrame:
    """Pieces (place, start, length, sequence_id, offset) of the documents of ``queue`` (place, source, n).

    Each source is a queue of its documents in hash order. In round r a source
    gets ``window`` times its share of ids as credit and sends packets (a
    document's next ``packet`` ids) while the credit lasts; what is left is its
    deficit for the next round. So a packet that ends at the E-th id of its
    queue goes in round ceil(E / credit a round), which needs only running
    totals, and every window holds each source's share to within a packet. The
    shares are the sources' shares of all ids, so all queues end together, or
    ``weights`` by source (null as None); a source not named has weight 1. The
    packets of all rounds in order fill the windows without a gap.

    Running totals are taken inside blocks of about the square root of the
    rows, and over the totals of the blocks.
    """
    totals = queue.groupBy("source").agg(F.sum("n").alias("queued"))
    if weights is None:
        totals = totals.withColumn("weight", F.col("queued").cast("double"))
    else:
        pairs = [F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(float(w))) for s, w in weights.items()]
        totals = totals.withColumn("weight", F.coalesce(*pairs, F.lit(1.0)))
    totals = stage(totals, "queues")
    size = _size(queue, packet)
    weight = totals.agg(F.sum("weight")).first()[0] or 1.0
    hashed = F.xxhash64("place")
    rows = queue.withColumn("hash", hashed).withColumn("block", hash_block(F.col("hash"), block_count(size["rows"])))
    rows = running_total(rows, ["source"], "block", ["hash"], "n", "queue_at")
    rows = joined(rows.select("place", "source", "n", "queue_at"), totals.select("source", "weight"), ["source"])
    packets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long")))
    rows = rows.select("place", "source", "n", "queue_at", "weight", packets.alias("start"))
    rows = rows.withColumn("length", F.least(F.lit(packet).cast("long"), F.col("n") - F.col("start")))
    end = (F.col("queue_at") + F.col("start") + F.col("length")).cast("double")
    rows = rows.withColumn("round", F.ceil(end / (F.lit(float(window)) * F.col("weight") / F.lit(float(weight)))).cast("long"))
    return _laid(rows, size, window)


def in_order(queue: DataFrame, window: int = WINDOW, packet: int = PACKET, spans: int = SPANS) -> DataFrame:
    """``scheduled`` for a ``queue`` with ``rank``, the order that the documents come in (no two alike).

    The ids are cut into ``spans`` equal spans in that order, a document
    belongs to the span that it begins in. A source's credit in the rounds of a
    span is its share of the span's ids, and its queue is in the order too. So
    shares that move along the order move along the windows.
    """
    size = _size(queue, packet)
    bits = max(1, block_count(size["rows"]).bit_length())
    rows = queue.withColumn("block", F.shiftright("rank", bits))
    rows = running_total(rows, [], "block", ["rank"], "n", "all_at")
    rows = rows.withColumn("part", F.floor(F.col("all_at") / max(1.0, (size["ids"] or 1) / spans)).cast("long"))
    rows = stage(rows.select("place", "source", "n", "rank", "block", "part"), "queue-spans")
    shares = rows.groupBy("part", "source").agg(F.sum("n").alias("part_source"))
    parts = rows.groupBy("part").agg(F.sum("n").alias("part_ids"))
    # At most ``spans`` rows.
    parts = parts.withColumn("part_at", F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    shares = stage(joined(shares, parts, ["part"]), "span-shares")
    rows = running_total(rows, ["source", "part"], "block", ["rank"], "n", "queue_at")
    rows = joined(rows.drop("block", "rank"), shares, ["part", "source"])
    packets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long")))
    rows = rows.withColumn("start", packets).withColumn("length", F.least(F.lit(packet).cast("long"), F.col("n") - F.col("start")))
    end = (F.col("queue_at") + F.col("start") + F.col("length")) / F.col("part_source")
    rows = rows.withColumn("round", F.ceil((F.col("part_at") + end * F.col("part_ids")) / window).cast("long"))
    # Where spans meet in a round, the earlier one's packets of a source come first.
    return _laid(rows.withColumn("queue_at", F.col("part_at") + F.col("queue_at")), size, window)


def _size(queue: DataFrame, packet: int):
    return queue.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("ids"), F.sum(F.ceil(F.col("n") / packet)).alias("packets")).first()


def _laid(rows: DataFrame, size, window: int) -> DataFrame:
    """Pieces of the packets (place, source, start, length, round, queue_at) when all rounds are laid end to end."""
    # With weights the last rounds hold few ids; rounds are cut into spans by the ids they can hold.
    spans = block_count(size["packets"] or 1)
    step = max(1.0, (size["ids"] or 1) / window / spans)
    rows = rows.withColumn("span", F.floor(F.col("round") / F.lit(step)).cast("long"))
    rows = stage(rows.select("place", "source", "start", "length", "round", "span", "queue_at"), "packets")
    order = ["round", "source", "queue_at", "start"]
    rows = running_total(rows, [], "span", order, "length", "at")
    last = F.col("at") + F.col("length") - 1
    rows = rows.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("at") / window), F.floor(last / window))))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * window)
    stop = F.least(last + 1, (F.col("sequence_id") + 1) * window)
    return rows.select(
        "place",
        (F.col("start") + begin - F.col("at")).alias("start"),
        (stop - begin).alias("length"),
        "sequence_id",
        (begin - F.col("sequence_id") * window).alias("offset"),
    )


def merged(pieces: list[dict]) -> list[list[int]]:
    """(start, length, sequence, offset) of a document in order; neighbours that touch become one."""
    out: list[list[int]] = []
    for p in sorted(pieces, key=lambda p: p["start"]):
        if out and out[-1][2] == p["sequence_id"] and out[-1][3] + out[-1][1] == p["offset"]:
            out[-1][1] += p["length"]
        else:
            out.append([p["start"], p["length"], p["sequence_id"], p["offset"]])
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids array<int>"


def packed(
    docs: DataFrame,
    weights: dict | None = None,
    window: int = WINDOW,
    packet: int = PACKET,
    end: int = END,
    paths: tuple[str, str] | None = None,
    with_ids: bool = True,
    order: Column | None = None,
) -> DataFrame:
    """The pieces of all documents in sequences of ``window`` ids: PIECES, ``ids`` null if not asked for.

    Ids are written once, compressed. Only lengths take part in the schedule,
    and its pieces return to the ids by the written row's place. All sequences
    but the last are full.

    Null or empty text: the end id alone. Null doc_id: packed like any other.
    Null source: a queue of its own. A text that exceeds a window is cut.
    Repeated rows are packed each. Empty table: no rows. Other columns are
    ignored.
    """
    rows = placed(tokenized(docs, paths or vocabulary(), end, order), "ids")
    if order is None:
        pieces = scheduled(rows.select("place", "source", "n"), weights, window, packet)
    else:
        pieces = in_order(rows.select("place", "source", "n", "rank"), window, packet)
    pieces = pieces.groupBy("place").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    rows = rows.select("place", "doc_id", "source", "n", "ids").join(pieces, "place").drop("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, out = batch.slice(low, 256).to_pylist(), []
                for row in part:
                    body = pa.decompress(row["ids"], 2 * row["n"], "zstd", asbytes=True)
                    ids = np.frombuffer(body, "<u2").astype("<u4")
                    for start, length, sequence, offset in merged(row["pieces"]):
                        own = ids[start : start + length]
                        out.append((row["doc_id"], start, length, zlib.crc32(own.tobytes()), row["n"], sequence, offset, row["source"], own.astype("<i4") if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], NAMES)

    return rows.mapInArrow(run, PIECES)


NAMES = [field.split()[0] for field in PIECES.split(", ")]
TYPES = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.int32())]
