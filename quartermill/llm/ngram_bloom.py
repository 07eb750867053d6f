"""Language-model scoring from a log-frequency Bloom filter of n-gram counts."""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.llm.common import joined, placed, remainder
from quartermill.llm.textbatch import Words, blocks, mixed
from quartermill.session import stage

#: Stands for the end token among word hashes.
END = np.uint64(0x2545F4914F6CDD1D)
#: A count c is kept as level 1 + floor(log(c) / log(BASE)).
BASE = 1.5
#: Bits for each inserted (n-gram, level) and the probes for one.
BITS_PER_ENTRY, PROBES = 12, 6
#: A filter up to this size is broadcast; a larger one stays in buckets that are probed by shuffle.
MAX_FILTER_BYTES = 64 << 20
SECTION_BYTES = 256 << 10
#: Text of a block, whose n-grams are counted or asked for together, and text whose n-grams make a bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Exact counts of at most this many words are broadcast; rarer words are joined by shuffle.
MAX_WORDS = 2_000_000
#: Weight of the word model in a bigram's estimate, in counts.
PRIOR = 60.0


def level_of(count):
    return (F.floor(F.log(count) / F.lit(math.log(BASE)) + 1e-9) + 1).cast("int")


def count_of_levels(most: int = 128) -> np.ndarray:
    """The middle of the counts that share a level, by level; 0 for level 0."""
    out = [0.0]
    for level in range(1, most):
        low, high = math.ceil(BASE ** (level - 1) - 1e-9), math.ceil(BASE**level - 1e-9) - 1
        out.append((low + high) / 2 if high >= low else BASE ** (level - 0.5))
    return np.array(out)


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in a row, each text closed by END; the texts' bounds in them."""
    texts = len(words.counts)
    owner = np.repeat(np.arange(texts), words.counts)
    out = np.full(len(owner) + texts, END, np.uint64)
    out[np.arange(len(owner)) + owner] = words.hashes()
    return out, words.first + np.arange(texts + 1)


def pairs(stream: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it; a text's first token follows an END."""
    with np.errstate(over="ignore"):
        before = np.concatenate([[END], stream[:-1]])
        return mixed(before * np.uint64(0x9E3779B97F4A7C15) + stream)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The hash range cut into equal spans: sorted keys lie in ascending buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte plane by byte plane, compressed."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def keys_of(texts: pa.Array) -> list[np.ndarray]:
    """Words and word pairs of the texts; each list ascending and distinct."""
    stream, _ = tokens(Words(texts, lower=True))
    return [np.unique(stream), np.unique(pairs(stream))]


def counted_keys(texts: pa.Array, learnt: np.ndarray, asked: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of the words and of the word pairs: how often the marked texts hold each.

    Keys ascend. Texts are hashed once and every token is sorted once: those of
    the other texts, which are wanted if ``asked``, join with a count of zero.
    """
    stream, bounds = tokens(Words(texts, lower=True))
    mark = np.repeat(learnt, np.diff(bounds))
    out = []
    for keys in (stream, pairs(stream)):
        held, times = np.unique(keys[mark], return_counts=True)
        if asked and not mark.all():
            rest = np.unique(keys[~mark])
            at = np.searchsorted(held, rest)
            new = np.ones(len(rest), bool)
            inside = at < len(held)
            new[inside] = held[at[inside]] != rest[inside]
            held, times = np.insert(held, at[new], rest[new]), np.insert(times, at[new], 0)
        out.append((held, times.astype(np.uint32)))
    return out


def sent(block: pa.RecordBatch, number: int, buckets: int) -> pa.RecordBatch:
    """(bucket, text_block, grams, n, keys, counts) of a block: its distinct n-grams and how often its learnt rows hold each.

    ``text_block`` is null where no row asks for an answer.
    """
    texts, asked = block.column("text"), block.column("asked").to_numpy(zero_copy_only=False).any()
    learnt = block.column("learnt").to_numpy(zero_copy_only=False)
    columns = [[], [], [], []]
    for grams, (found, counts) in zip((1, 2), counted_keys(texts, learnt, asked)):
        edges = np.searchsorted(bucket_of(found, buckets), np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(edges)):
            at = slice(edges[i], edges[i + 1])
            row = (i, grams, packed(found[at]), pa.compress(counts[at].tobytes(), "zstd", asbytes=True))
            for column, value in zip(columns, row):
                column.append(value)
        columns.append(np.diff(edges)[np.diff(edges) > 0])
    n = np.concatenate(columns[4:]).astype(np.int32)
    out = [
        pa.array(columns[0], pa.int32()),
        pa.array([number if asked else None] * len(n), pa.int64()),
        pa.array(columns[1], pa.int8()),
        pa.array(n, pa.int32()),
        pa.array(columns[2], pa.binary()),
        pa.array(columns[3], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(out, ["bucket", "text_block", "grams", "n", "keys", "counts"])


SENT = "bucket int, text_block long, grams byte, n int, keys binary, counts binary"


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def section_of(keys: np.ndarray, sections: np.ndarray) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0x5851F42D4C957F2D)) % sections).astype(np.int64)


def draws(keys: np.ndarray, level: int, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bit and (odd) step between the bits of a key at a level; a section has ``mask`` + 1 bits, a power of two."""
    with np.errstate(over="ignore"):
        hashed = mixed(keys + np.uint64((level * 0xD1B54A32D192ED03) & (1 << 64) - 1))
    return hashed >> np.uint64(32) & mask, hashed & mask | np.uint64(1)


def filled(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """(sections, bytes of a section) of the Bloom filter of a bucket's n-grams."""
    need = int(levels.sum()) * BITS_PER_ENTRY // 8
    size = min(SECTION_BYTES, 1 << max(6, need.bit_length()))
    out = np.zeros((max(1, math.ceil(need / size)), size), np.uint8)
    own = section_of(keys, np.uint64(len(out)))
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(len(out) + 1))
    mask = np.uint64(size * 8 - 1)
    for section in range(len(out)):
        at = order[edges[section] : edges[section + 1]]
        bits = np.zeros(size * 8, bool)
        for level in range(1, int(levels[at].max(initial=0)) + 1):
            place, step = draws(keys[at[levels[at] >= level]], level, mask)
            for _ in range(PROBES):
                bits[place.view(np.int64)] = True
                place = (place + step) & mask
        out[section] = np.packbits(bits, bitorder="little")
    return out


@dataclass
class Filter:
    """Bit sections of some buckets, one after another; a key's bucket, section and probes follow from its hash."""

    bits: np.ndarray
    start: np.ndarray
    sections: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(found: dict[int, np.ndarray], buckets: int) -> "Filter":
        """From the sections by bucket; a bucket without any holds nothing."""
        parts = [found.get(i, np.zeros((1, 64), np.uint8)) for i in range(buckets)]
        sections, size = (np.array([p.shape[i] for p in parts], np.int64) for i in (0, 1))
        start = np.concatenate([[0], np.cumsum(sections * size)[:-1]])
        return Filter(np.concatenate([p.reshape(-1) for p in parts]), start, sections, size)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which a key was inserted, 0 if at none; errs only upwards, rarely."""
        found = np.zeros(len(keys), np.int64)
        bucket = bucket_of(keys, len(self.start))
        size = self.size[bucket]
        start = self.start[bucket] + section_of(keys, self.sections[bucket].astype(np.uint64)) * size
        mask = (size * 8 - 1).astype(np.uint64)
        active, level = np.arange(len(keys)), 1
        while len(active) and level < 127:
            at, step = draws(keys, level, mask)
            for _ in range(PROBES):
                byte = self.bits[start + (at >> np.uint64(3)).view(np.int64)]
                hit = np.flatnonzero(byte >> (at & np.uint64(7)).astype(np.uint8) & 1)
                active, keys, start, step, mask = active[hit], keys[hit], start[hit], step[hit], mask[hit]
                at = (at[hit] + step) & mask
            found[active] = level
            level += 1
        return found


def met(keys: DataFrame, with_bits: bool) -> DataFrame:
    """Counts summed, the filter filled and asked, all in the task of a bucket; the result is written.

    A row for each row of ``keys`` that asks: text_block, bucket, grams, n and
    ``levels``, a byte for each of its keys. A row for each bucket: its words
    with their exact counts and, if wanted, the bits of its filter. A bucket
    holds the n-grams of about BUCKET_BYTES of text, however long the table.
    """

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in group for row in batch.to_pylist()]
        parts = {1: [], 2: []}
        for row in rows:
            times = np.frombuffer(pa.decompress(row["counts"], 4 * row["n"], "zstd", asbytes=True), np.uint32)
            if times.any():
                parts[row["grams"]].append((unpacked(row["keys"], row["n"])[times > 0], times[times > 0]))
        words, times = summed(parts[1])
        both, counts = summed(parts[2])
        counts = np.concatenate([times, counts])
        levels = np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64) + 1
        sections = filled(np.concatenate([words, both]), levels)
        held = Filter.of({0: sections}, 1)
        out = [{"bucket": rows[0]["bucket"], "words": words.view(np.int64), "times": times}]
        if with_bits:
            out[0] |= {"size": sections.shape[1], "bits": sections.tobytes()}
        for row in rows:
            if row["text_block"] is not None:
                found = held.levels(unpacked(row["keys"], row["n"])).astype(np.uint8)
                levels = pa.compress(found.tobytes(), "zstd", asbytes=True)
                out.append({c: row[c] for c in ("text_block", "bucket", "grams", "n")} | {"levels": levels})
        yield pa.RecordBatch.from_pylist(out, schema=MET)

    schema = "text_block long, bucket int, grams byte, n int, levels binary, size int, bits binary, words array<long>, times array<long>"
    return stage(keys.groupBy("bucket").applyInArrow(run, schema), "ngram-answers")


MET = pa.schema(
    [("text_block", pa.int64()), ("bucket", pa.int32()), ("grams", pa.int8()), ("n", pa.int32()), ("levels", pa.binary())]
    + [("size", pa.int32()), ("bits", pa.binary()), ("words", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def sections_in(row: dict) -> np.ndarray:
    return np.frombuffer(row["bits"], np.uint8).reshape(-1, row["size"])


def in_blocks(rows: DataFrame) -> DataFrame:
    """(text_block, asks, rows): blocks of rows with about BLOCK_BYTES of text, each written as one compressed value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for n, block in enumerate(blocks(batches, limit=BLOCK_BYTES)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, block.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(block)
            asked = block.column("asked").to_numpy(zero_copy_only=False).any()
            columns = [pa.array([first + n], pa.int64()), pa.array([asked]), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["text_block", "asks", "rows"])

    return stage(rows.mapInArrow(run, "text_block long, asks boolean, rows binary"), "score-blocks")


def rows_in(value: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(value.as_buffer()).read_next_batch()


def scored(
    docs: DataFrame,
    train: DataFrame | str,
    max_bytes: int = MAX_FILTER_BYTES,
    max_words: int = MAX_WORDS,
    prior: float = PRIOR,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of ``docs``, n_tokens, n_known, train_tokens, base_score and score of every row.

    ``train`` is a table of texts, or the name of a boolean column of ``docs``
    that marks the rows to learn from. Words and word pairs are counted in
    blocks and summed by bucket of their hash; the counts, cut to levels, go
    into the bucket's Bloom filter, which grows with the n-grams. A filter that
    surely has at most ``max_bytes`` is broadcast. Beyond that the n-grams of a
    block go to their buckets once, to be counted and asked for; the answers
    meet the block again. A text's probability is the product over its tokens of
    (c(previous, token) + prior * p(token)) / (c(previous) + prior), where p is
    the add-one word estimate and every c comes from repeated membership
    probes. ``base_score`` uses exact word counts: those of the commonest words
    are broadcast (at most ``max_words``), the rest is joined by shuffle.

    Null or empty text: the end token alone. Nothing to learn from: every
    token is unknown, N and V are 0. Null ids take part. Repeated rows are
    scored alike. Empty table: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string").alias("text")
    if isinstance(train, str):
        rows = docs.select(*keep, text, F.coalesce(F.col(train), F.lit(False)).alias("learnt"), F.lit(True).alias("asked"))
    else:
        rows = docs.select(*keep, text, F.lit(False).alias("learnt"), F.lit(True).alias("asked"))
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.select(*keep).schema]
        rows = rows.unionByName(train.select(*none, text, F.lit(True).alias("learnt"), F.lit(False).alias("asked")))
    length = F.octet_length("text")
    size = rows.agg(F.sum(length), F.sum(F.when(F.col("learnt"), length)), F.count_if("learnt")).first()
    buckets = max(1, math.ceil((size[0] or 0) / BUCKET_BYTES))
    # A text has at most (bytes + 3) / 2 tokens and a token two n-grams, each an entry at most: this is sure before anything is counted.
    fits = ((size[1] or 0) + 3 * size[2]) * BITS_PER_ENTRY // 8 + buckets * SECTION_BYTES <= max_bytes

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK_BYTES):
            yield sent(block, 0, buckets)

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, value in zip(batch.column("text_block"), batch.column("rows")):
                yield sent(rows_in(value), number.as_py(), buckets)

    if fits:
        learnt = rows.where("learnt").select("text", "learnt", F.lit(False).alias("asked"))
        answers = met(learnt.mapInArrow(of_rows, SENT), True)
    else:
        held_rows = in_blocks(rows)
        answers = met(held_rows.mapInArrow(of_blocks, SENT), False)
    counts = answers.where("words is not null").select(F.inline(F.arrays_zip(F.col("words").alias("hash"), F.col("times").alias("count"))))
    counts = counts.withColumn("level", level_of(F.col("count")))
    histogram = counts.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total")).collect()
    total = sum(r["total"] for r in histogram)
    distinct = sum(r["n"] for r in histogram)
    held, common = 0, 1 + max((r["level"] for r in histogram), default=0)
    for r in sorted(histogram, key=lambda r: -r["level"]):
        if held + r["n"] > max_words:
            break
        held, common = held + r["n"], r["level"]
    exact = counts.where(F.col("level") >= common).select("hash", "count").toArrow()
    names, times = exact["hash"].to_numpy().view(np.uint64), exact["count"].to_numpy()
    order = np.argsort(names)
    # At most max_bytes in all; the buckets arrive one partition at a time.
    arriving = answers.where("bits is not null").select("bucket", "size", "bits").toLocalIterator() if fits else []
    bits = Filter.of({row["bucket"]: sections_in(row) for row in arriving}, buckets) if fits else None
    shared = spark.sparkContext.broadcast((bits, names[order], times[order].astype(np.int64)))
    base = math.log10(total + distinct + 1)
    weight = count_of_levels()
    whole = held == distinct

    def score(found_blocks: Iterator[pa.RecordBatch], levels) -> Iterator[pa.RecordBatch]:
        _, words, word_counts = shared.value
        for block in found_blocks:
            stream, bounds = tokens(Words(block.column("text"), lower=True))
            found, where = np.unique(stream, return_inverse=True)
            at = np.minimum(np.searchsorted(words, found), max(len(words) - 1, 0))
            known = words[at] == found if len(words) else np.zeros(len(found), bool)
            c = np.where(known, word_counts[at] if len(words) else 0, 0)
            one = weight[levels(found)]
            single = (one + 1.0) / (total + distinct + 1.0)
            two = weight[levels(pairs(stream))]
            last = np.concatenate([[END], stream[:-1]])
            end_count = one[np.searchsorted(found, END)] if len(found) else 0.0
            history = np.concatenate([[end_count], one[where[:-1]]]) if len(stream) else one
            two = np.where(last == END, np.minimum(two, end_count), np.minimum(two, history))
            logs = np.log10((two + prior * single[where]) / (history + prior))
            in_base = np.where(known | whole, np.log10(c + 1.0) - base, 0.0)[where]
            sums = lambda values: np.add.reduceat(values, bounds[:-1]) if len(values) else values
            n = np.diff(bounds)
            columns = [block.column(i) for i in range(len(keep))]
            columns += [pa.array(n), pa.array(sums((c > 0)[where].astype(np.int64))), pa.array(sums(in_base)), pa.array(sums(logs))]
            if whole:
                rest = pa.nulls(len(n), pa.list_(pa.int64()))
            else:
                unknown = ~known[where]
                ends = np.concatenate([[0], np.cumsum(sums(unknown.astype(np.int64)))])
                rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(stream[unknown].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*columns, rest], [*keep, "n_tokens", "n_known", "base_score", "score", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return score(blocks(batches), shared.value[0].levels)

    def run_block(block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows_in(block["rows"][0])
        answers = answers.sort_by([("grams", "ascending"), ("bucket", "ascending")])
        parts = [pa.decompress(x.as_py(), n.as_py(), "zstd", asbytes=True) for x, n in zip(answers["levels"], answers["n"])]
        hashes, found = np.concatenate(keys_of(rows.column("text"))), np.frombuffer(b"".join(parts), np.uint8)
        order = np.argsort(hashes, kind="stable")
        hashes, found = hashes[order], found[order].astype(np.int64)
        rows = rows.filter(rows.column("asked"))
        return pa.Table.from_batches(score(blocks(iter([rows])), lambda keys: found[np.searchsorted(hashes, keys)]))

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.select(*keep).dtypes)
    schema = f"{schema}, n_tokens long, n_known long, base_score double, score double, rest array<long>"
    if fits:
        out = rows.where("asked").mapInArrow(run, schema)
    else:
        answered = answers.where("text_block is not null").select("text_block", "bucket", "grams", "n", "levels")
        out = held_rows.where("asks").groupBy("text_block").cogroup(answered.groupBy("text_block")).applyInArrow(run_block, schema)
    if not whole:
        # Words outside the broadcast table are few tokens of each text.
        out = placed(out, "scores")
        rest = out.select("place", F.explode("rest").alias("hash")).groupBy("place", "hash").agg(F.count(F.lit(1)).alias("times"))
        rare = counts.where(F.col("level") < common).select("hash", "count")
        rest = joined(rest, rare, ["hash"], "left").withColumn("c", F.coalesce("count", F.lit(0)))
        rest = rest.groupBy("place").agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * (F.log10(F.col("c") + 1.0) - F.lit(base))).alias("more_score"),
        )
        out = joined(out, rest, ["place"], "left")
        out = out.withColumn("n_known", F.col("n_known") + F.coalesce("more_known", F.lit(0)))
        out = out.withColumn("base_score", F.col("base_score") + F.coalesce("more_score", F.lit(0.0)))
    return out.select(*keep, "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def trained_on(docs: DataFrame, divisor: int = 7, held_out: int = 2) -> tuple[DataFrame, DataFrame]:
    """``docs`` with held_out and learnt, and the rows to learn from; rows without an id are neither held out nor learnt from."""
    fold = remainder("doc_id", divisor)
    rows = docs.select("doc_id", "text").withColumn("learnt", F.coalesce(fold != held_out, F.lit(False)))
    return rows.withColumn("held_out", F.coalesce(fold == held_out, F.lit(False))), rows.where("learnt")
