"""Quality rules: word and line measures, and lines that many documents of a host share."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import joined
from quartermill.llm.textbatch import SPACE, Words, blocks, mixed
from quartermill.session import stage

#: A line is common on its host if more than this share of its documents,
#: and more than LEAST documents, hold it.
SHARE, LEAST = 0.05, 8
#: A document is depleted if its common lines hold more than this share of its words.
DEPLETED = 0.5
#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

#: What ends a word; other blanks, as U+00A0, are words.
BLANKS = " \t\n\x0b\x0c\r"

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: Words, window: int = 3) -> np.ndarray:
    """Words of each text that lie in a window of ``window`` words found twice or more in it."""
    total = np.zeros(len(words.counts), np.int64)
    if not len(words.starts):
        return total
    hashes = words.hashes()
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    heads = np.flatnonzero(np.arange(len(owner)) + window <= words.first[1:][owner])
    if not len(heads):
        return total
    with np.errstate(over="ignore"):
        keys = mixed(owner[heads].astype(np.uint64) + np.uint64(1))
        for step in range(window):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + hashes[heads + step])
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    equal = keys[order][1:] == keys[order][:-1]
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    inside = np.zeros(len(owner), bool)
    for step in range(window):
        inside[heads[again] + step] = True
    return words.per_words(inside)


def line_hash(line: bytes) -> int:
    """Hash of a line in lower case (A-Z) with single blanks."""
    return xxhash.xxh64_intdigest(b" ".join(line.split()).lower(), 7) - (1 << 63)


def measures(texts: pa.Array) -> dict[str, np.ndarray | list]:
    """Base measures, line hashes and words of each line, of every text."""
    words = Words(texts)
    data = words.data
    dup, keys, sizes = [], [], []
    for i, (a, b) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())):
        seen, doubles, own, held = set(), 0, [], []
        for line in bytes(data[a:b]).split(b"\n"):
            parts = line.split()
            if parts:
                doubles += line in seen
                seen.add(line)
                own.append(line_hash(line))
                held.append(len(parts))
        dup.append(doubles)
        keys.append(own)
        sizes.append(held)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": words.per_text(words.inside & ((data & 0xC0) != 0x80)),
        "n_symbols": words.per_text(SYMBOLS[data]),
        "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": repeated_words(words),
        "line_keys": keys,
        "line_words": sizes,
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_key, the measures and line arrays of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = measures(block.column("text"))
            lists = {name: pa.array(found.pop(name), pa.list_(pa.int64())) for name in ("line_keys", "line_words")}
            columns = {name: block.column(name) for name in ("doc_id", "host", "text_key")}
            columns |= {name: pa.array(values) for name, values in found.items()} | lists
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        run, f"doc_id long, host string, text_key long, {MEASURES}, line_keys array<long>, line_words array<long>"
    )


def judged(docs: DataFrame, share: float = SHARE, least: int = LEAST, depleted: float = DEPLETED) -> DataFrame:
    """doc_id, host, text_key, the measures, lost_words, common_lines, base_failed and kept of every row.

    Lines are compared in lower case with single blanks. Documents count by
    text: copies of one text are one document, so copying never makes a line
    common. ``lost_words`` are the words of lines that are common on the host;
    ``kept`` is false if a base rule fails or more than ``depleted`` of the
    words are lost.

    Null text: no words, fails the base rules. Null source: a host of its own.
    Repeated rows are judged alike. Empty table: no rows. Other columns are
    ignored.
    """
    rows = stage(measured(docs), "line-measures")
    held = rows.select("host", "text_key", F.explode(F.array_distinct("line_keys")).alias("line"))
    spread = held.groupBy("host", "line").agg(F.count_distinct("text_key").alias("holders"))
    hosts = rows.groupBy("host").agg(F.count_distinct("text_key").alias("texts"))
    common = joined(spread.where(F.col("holders") > least), hosts, ["host"])
    common = stage(common.where(F.col("holders") > share * F.col("texts")).select("host", "line"), "common-lines")
    words = rows.select(
        "doc_id", "host", "text_key", F.explode(F.arrays_zip(F.col("line_keys").alias("line"), F.col("line_words").alias("words"))).alias("l")
    )
    words = words.select("doc_id", "host", "text_key", "l.line", "l.words")
    lost = joined(words, common, ["host", "line"]).groupBy("doc_id", "host", "text_key")
    lost = lost.agg(F.sum("words").alias("words"), F.collect_set("line").alias("common_lines"))
    # Equal rows lose their words together, so the sum is divided by their number.
    counts = rows.groupBy("doc_id", "host", "text_key").agg(F.count(F.lit(1)).alias("row_n"))
    lost = joined(lost, counts, ["doc_id", "host", "text_key"])
    lost = lost.select("doc_id", "host", "text_key", (F.col("words") / F.col("row_n")).cast("long").alias("lost_words"), "common_lines")
    out = joined(rows.drop("line_keys", "line_words"), lost, ["doc_id", "host", "text_key"], "left")
    out = out.withColumn("lost_words", F.coalesce("lost_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= depleted * F.col("n_words")))


def filtered(docs: DataFrame, **options) -> DataFrame:
    """The kept rows of ``docs`` without their common lines; n_chars, if there, follows the text."""
    verdicts = judged(docs, **options).where("kept").groupBy("doc_id", "host", "text_key").agg(F.first("common_lines").alias("lines"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("text_key"))
    key = (
        rows["row.doc_id"].eqNullSafe(verdicts["doc_id"])
        & rows["row.source"].eqNullSafe(verdicts["host"])
        & (rows["text_key"] == verdicts["text_key"])
    )
    at, names = docs.columns.index("text"), docs.columns
    # By place, so that a column of ``docs`` may have any name.
    rows = rows.join(verdicts, key).select("row.*", "lines").toDF(*[f"c{i}" for i in range(len(names) + 1)])
    length = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(len(names)).to_pylist()
            columns = [batch.column(i) for i in range(len(names))]
            if any(lines):
                texts = [without(t, c) for t, c in zip(columns[at].to_pylist(), lines)]
                columns[at] = pa.array(texts, columns[at].type)
                if length is not None:
                    sizes = [len(t) if c else n for n, t, c in zip(columns[length].to_pylist(), texts, lines)]
                    columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, docs.schema)


def without(text: str | None, common: list[int] | None) -> str | None:
    """The text without the lines whose hash is in ``common``."""
    if not common or text is None:
        return text
    gone = set(common)
    return "\n".join(line for line in text.split("\n") if not line.strip(BLANKS) or line_hash(line.encode()) not in gone)
