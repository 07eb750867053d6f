"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put together again in another order.

A document becomes pieces of whole units (up to 64 KB each), keyed by document
and place in the output. ``repartitionAndSortWithinPartitions`` brings a
document's pieces together in that order, so that they pass through an
incremental digest one at a time: no text is ever built in memory as a whole.
The restoration reads only that stream and the form, keys what it finds by its
place in the text, and sorts once more; documents stay in their task, so that
second sort moves no piece over the network.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from quartermill.llm.common import joined
from quartermill.llm.textbatch import Words, blocks

SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of a piece; a longer unit is cut.
PIECE = 64 << 10
#: Place of a piece: its segment in the high bits. HEADER, before all, carries what is known of the document.
SEGMENT, HEADER = 1 << 40, -1
_MARK = re.compile(rb"<[PSM]>")
_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_KEY = [("doc_id", pa.int64()), ("text_key", pa.int64())]
_PIECES = pa.schema([*_KEY, ("place", pa.int64()), ("form", pa.string()), ("piece", pa.binary())])
_CUTS = pa.schema([*_KEY, ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers that depend on the seed and the id alone; a null id has none of its digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[a : a + 8], 16) for a in range(0, 32, 8)]


def cut(start: int, stop: int, ends: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Bounds of the pieces of bytes ``start`` to ``stop``: as many units (by their ``ends``) as fit, one empty piece if nothing is there."""
    at = start
    while stop - at > size:
        k = int(np.searchsorted(ends, at + size, "right"))
        after = int(ends[k - 1]) if k and ends[k - 1] > at else at + size
        yield at, after
        at = after
    yield at, stop


def _cut_texts(block: pa.RecordBatch, seed: int, fim: int, spm: int) -> Iterator[tuple]:
    """Of every text: its number, units, form, code points of prefix and middle, the segments in their output's order, its units' ends."""
    found = Words(block.column("text"))
    data = found.data.tobytes()
    letters = (found.data & 0xC0) != 0x80
    offsets, first = found.offsets.tolist(), found.first.tolist()
    for i, doc_id in enumerate(block.column("doc_id").to_pylist()):
        a, b = offsets[i], offsets[i + 1]
        ends = found.ends[first[i] : first[i + 1]]
        words = len(ends)
        n = words + (b > a and (not words or int(ends[-1]) < b))
        h1, h2, h3, h4 = draws(doc_id, seed)
        if a == b or h3 % 100 >= fim or any(data.find(m, a, b) >= 0 for m in _ORDER):
            yield i, n, "plain", None, None, [(b"", a, b)], ends, data
            continue
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m = (a if k == 0 else int(ends[k - 1]) if k <= words else b for k in (low, high))
        form = "spm" if h4 % 100 < spm else "psm"
        head, tail = (PREFIX, a, p), (SUFFIX, m, b)
        segments = [*((head, tail) if form == "psm" else (tail, head)), (MIDDLE, p, m)]
        yield i, n, form, int(np.count_nonzero(letters[a:p])), int(np.count_nonzero(letters[p:m])), segments, ends, data


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("text_key", F.xxhash64("text"))


def cuts(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """doc_id, text_key (a hash of the text), n (units), form, prefix_chars and middle_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = [found[1:5] for found in _cut_texts(block, seed, fim, spm)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_CUTS)[2:])]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("text_key"), *columns], schema=_CUTS)

    return _keyed(docs).mapInArrow(run, from_arrow_schema(_CUTS))


def _pieces(seed: int, fim: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for block in blocks(batches):
            owner, places, forms, pieces = [], [], [], []
            for i, _, form, _, _, segments, ends, data in _cut_texts(block, seed, fim, spm):
                rows = [(HEADER, b"")]
                for segment, (mark, start, stop) in enumerate(segments):
                    for number, (x, y) in enumerate(cut(start, stop, ends)):
                        rows.append((segment * SEGMENT + number, pack((b"" if number else mark) + data[x:y])))
                owner += [i] * len(rows)
                forms += [form] * len(rows)
                places += [place for place, _ in rows]
                pieces += [piece for _, piece in rows]
            key = [block.column(c).take(pa.array(owner, pa.int64())) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays([*key, pa.array(places, pa.int64()), pa.array(forms), pa.array(pieces, pa.binary())], schema=_PIECES)

    return run


def _task(key: tuple) -> int:
    """Task of a document: a mix of its id and text, so that any number of tasks is dealt evenly."""
    return ((key[1] ^ key[2]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32


def _merged(records: Iterator) -> Iterator:
    """Records of rows with equal id and text come several times, one after another; each once."""
    last = None
    for key, value in records:
        if key != last:
            yield key, value
        last = key


def output_pieces(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> RDD:
    """Records ((no_id, doc_id, text_key, place), value), each document's together and in the order of its output.

    The first one of a document has the place ``HEADER`` and its form as value;
    the others hold compressed bytes of the output. Keys are made of the row
    alone, so a repeated task sends the same; rows equal in id and text are one
    document.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keyed(found) -> tuple:
        value = found.form if found.place == HEADER else bytes(found.piece)
        return (found.doc_id is None, found.doc_id or 0, found.text_key, found.place), value

    rows = _keyed(docs).mapInArrow(_pieces(seed, fim, spm), from_arrow_schema(_PIECES))
    return rows.rdd.map(keyed).repartitionAndSortWithinPartitions(parts, _task).mapPartitions(_merged, True)


def _streamed(records: Iterator) -> Iterator:
    """Digests outputs as they stream by; sends on what the restoration finds in them, under its place in the text."""
    unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    document, form, digest = None, None, None

    def header() -> tuple:
        # The output of a plain document is its text, in the text's order.
        seen = digest.hexdigest()
        return (*document, HEADER), (seen, seen if form == "plain" else None)

    for (*key, place), value in records:
        if place == HEADER:
            if document is not None:
                yield header()
            document, form, digest = key, value, hashlib.sha256()
            segment = number = 0
            continue
        piece = unpack(value)
        digest.update(piece)
        if form == "plain":
            continue
        start = 0
        for mark in [*_MARK.finditer(piece), None]:
            stop = mark.start() if mark else len(piece)
            if stop > start:
                yield (*document, segment * SEGMENT + number), pack(piece[start:stop])
                number += 1
            if mark:
                segment, number, start = _ORDER[mark.group()], 0, mark.end()
    if document is not None:
        yield header()


def _restored(records: Iterator) -> Iterator[tuple]:
    """Digests the restored texts as they stream by: (doc_id, text_key, output's digest, text's digest)."""
    unpack = zstandard.ZstdDecompressor().decompress
    document, seen, digest = None, None, None

    def row() -> tuple:
        no_id, doc_id, text_key = document
        return None if no_id else doc_id, text_key, seen[0], seen[1] or digest.hexdigest()

    for (*key, place), value in records:
        if place == HEADER:
            if document is not None:
                yield row()
            document, seen, digest = key, value, hashlib.sha256()
        else:
            digest.update(unpack(value))
    if document is not None:
        yield row()


def digested(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the digests of the output and of the restored text of every row.

    A unit is a word with the blanks before it, or the blanks after the last
    word. Null text: empty, plain. Texts that hold a marker are plain. A null
    doc_id draws its cuts from the seed alone; rows of one id share their
    draws and are transformed each on its own; rows equal in id and text are
    transformed once, and each has the result. Empty table:
    no rows. Other columns are ignored.
    """
    outputs = output_pieces(docs, seed, fim, spm)
    # The streams stay with their task, so the second sort moves nothing between tasks.
    texts = outputs.mapPartitions(_streamed, True).repartitionAndSortWithinPartitions(outputs.getNumPartitions(), _task)
    schema = "doc_id long, text_key long, output_sha256 string, restored_sha256 string"
    found = docs.sparkSession.createDataFrame(texts.mapPartitions(_restored, True), schema, verifySchema=False)
    return joined(cuts(docs, seed, fim, spm), found, ["doc_id", "text_key"]).drop("text_key")


def transformed(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """The outputs themselves: doc_id, text_key, form, place and piece (bytes), in order inside a document.

    Concatenated by place, a document's pieces are its output; an empty one has
    one empty piece. Rows equal in id and text are one document here.
    """

    def rows(records: Iterator) -> Iterator[tuple]:
        unpack = zstandard.ZstdDecompressor().decompress
        form = None
        for (no_id, doc_id, text_key, place), value in records:
            if place == HEADER:
                form = value
            else:
                yield None if no_id else doc_id, text_key, form, place, unpack(value)

    schema = "doc_id long, text_key long, form string, place long, piece binary"
    found = output_pieces(docs, seed, fim, spm).mapPartitions(rows, True)
    return docs.sparkSession.createDataFrame(found, schema, verifySchema=False)
