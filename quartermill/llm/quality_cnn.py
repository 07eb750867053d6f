"""Quality classifier: a byte-level convolutional network over overlapping chunks of the whole text."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.llm.common import one_row_each, remainder
from quartermill.llm.textbatch import blocks

#: A chunk is two neighbouring halves, so chunks overlap by half.
HALF, STRIDE, WIDTH = 128, 2, 6
EMBED, FILTERS, HIDDEN = 8, 16, 16
#: Bound of the sample that is learnt from: labelled documents, and chunks of each.
SAMPLE_DOCS, SAMPLE_CHUNKS = 4_000, 6
#: Passes over the sample; a small sample is passed until LEAST_STEPS steps are done.
EPOCHS, LEAST_STEPS, BATCH, RATE = 6, 400, 32, 0.01
THRESHOLD = 0.3
SCORE = "quality_cnn_score"
STEPS = HALF // STRIDE
CHUNK = 2 * HALF + WIDTH - STRIDE


@dataclass
class Network:
    """Byte embedding, filters, a hidden layer, and the weights to one logit."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 7) -> "Network":
        draw = np.random.default_rng(seed).normal
        return cls(
            draw(0, 0.5, (256, EMBED)).astype(np.float32),
            draw(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            draw(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            draw(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def tables(self) -> np.ndarray:
        """What each byte adds to every filter at each place in it: (place, byte, filter)."""
        return np.stack([self.embed @ self.filters[k * EMBED : (k + 1) * EMBED] for k in range(WIDTH)])

    def halves(self, data: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Filter maxima over each half chunk of ``data``, whose length is a multiple of HALF plus WIDTH - STRIDE."""
        count = (len(data) - WIDTH + STRIDE) // HALF
        out = np.empty((count, FILTERS), np.float32)
        for low in range(0, count, 512):
            n = min(512, count - low)
            part = data[low * HALF : (low + n) * HALF + WIDTH - STRIDE]
            total = tables[0].take(part[: n * HALF : STRIDE], axis=0)
            for k in range(1, WIDTH):
                total += tables[k].take(part[k : k + n * HALF - (STRIDE - 1) : STRIDE][: n * STEPS], axis=0)
            out[low : low + n] = total.reshape(n, STEPS, FILTERS).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def probability(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum(features @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias, -30, 30).astype(np.float64)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of every text, all its bytes read.

        A chunk's features are the filters' maxima over it; a text's are the
        mean over its chunks.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = np.maximum(1, -(-sizes // HALF))
        # One half of zeros parts neighbouring texts, so no filter sees two of them.
        first = np.concatenate([[0], np.cumsum(counts + 1)])
        data = np.zeros(int(first[-1]) * HALF + WIDTH - STRIDE, np.uint8)
        for start, text in zip(first.tolist(), texts):
            data[start * HALF : start * HALF + len(text)] = np.frombuffer(text, np.uint8)
        halves = self.halves(data, self.tables())
        if not len(texts):
            return np.zeros(0)
        following = np.concatenate([halves[1:], halves[:1]])
        owner = np.repeat(np.arange(len(texts)), counts + 1)
        place = np.arange(len(halves)) - first[:-1][owner]
        # The last half of a text starts no chunk of its own unless it is the only one.
        starts = (place < counts[owner] - 1) | (counts[owner] == 1) & (place == 0)
        alone = (counts[owner] == 1)[:, None]
        chunks = np.where(alone, halves, np.maximum(halves, following))[starts]
        heads = np.concatenate([[0], np.cumsum(np.maximum(1, counts - 1))[:-1]])
        features = np.add.reduceat(chunks, heads, axis=0, dtype=np.float64) / np.maximum(1, counts - 1)[:, None]
        return self.probability(features.astype(np.float32))


def fit(chunks: list[list[bytes]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Trains on the sampled chunks of labelled documents with Adam; classes weigh the same."""
    net = Network.fresh(seed)
    if not len(labels) or labels.min() == labels.max():
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(labels) else (10 if labels[0] else -10)
        return net
    rng = np.random.default_rng(seed)
    batches = max(1, len(labels) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // batches))
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    steps = 0
    offsets = np.arange(2 * STEPS)[:, None] * STRIDE + np.arange(WIDTH)
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(len(labels)), batches):
            parts = [c for i in batch for c in chunks[i]]
            owner = np.repeat(np.arange(len(batch)), [len(chunks[i]) for i in batch])
            data = np.frombuffer(b"".join(p.ljust(CHUNK, b"\0")[:CHUNK] for p in parts), np.uint8).reshape(-1, CHUNK)
            short = np.array([len(p) <= HALF for p in parts])
            windows = data[:, offsets]
            inputs = net.embed[windows].reshape(len(parts), 2 * STEPS, WIDTH * EMBED)
            response = inputs @ net.filters + net.bias
            response[short, STEPS:] = -1e9
            peak = response.argmax(axis=1)
            rows = np.arange(len(parts))[:, None]
            top = response[rows, peak, np.arange(FILTERS)]
            pooled = np.maximum(top, 0)
            n = np.bincount(owner, minlength=len(batch)).astype(np.float32)
            features = np.zeros((len(batch), FILTERS), np.float32)
            np.add.at(features, owner, pooled)
            features /= n[:, None]
            before = features @ net.hidden + net.hidden_bias
            hidden = np.maximum(before, 0)
            prob = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
            slope = (weight[batch] * (prob - labels[batch]) / len(batch)).astype(np.float32)
            d_before = slope[:, None] * net.out * (before > 0)
            d_features = d_before @ net.hidden.T / n[:, None]
            d_top = d_features[owner] * (top > 0)
            seen = inputs[rows, peak]
            d_filters = np.einsum("pfe,pf->ef", seen, d_top)
            d_seen = d_top[:, :, None] * net.filters.T
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, windows[rows, peak].reshape(-1), d_seen.reshape(-1, EMBED))
            grads = [d_embed, d_filters, d_top.sum(0), features.T @ d_before, d_before.sum(0), hidden.T @ slope, slope.sum(keepdims=True)]
            steps += 1
            rate = RATE * (0.5 if epoch * 2 >= epochs else 1.0)
            for p, g, (m, v) in zip(net.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


def sampled(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS, chunks: int = SAMPLE_CHUNKS):
    """(chunks, label) of at most ``most`` labelled documents, chosen by a hash of the id.

    Of each document ``chunks`` chunks are taken, evenly over all of it; of
    rows that share an id one counts, that of the least text hash. Only chosen
    ids and chunks reach the driver.
    """
    chosen = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = []
            for text in block.column("text").to_pylist():
                body = (text or "").encode()
                last = max(0, -(-len(body) // HALF) - 2)
                starts = sorted({round(last * i / max(1, chunks - 1)) for i in range(chunks)})
                out.append([body[s * HALF : s * HALF + CHUNK] for s in starts])
            columns = [block.column("doc_id"), block.column("quality"), pa.array(out, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "chunks"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = one_row_each(rows, chosen, ["doc_id"]).select("doc_id", "quality", "text")
    found = rows.mapInArrow(run, "doc_id long, quality int, chunks array<binary>").toArrow()
    order = np.lexsort([found["doc_id"].to_numpy()]) if found.num_rows else []
    parts, marks = found["chunks"].to_pylist(), found["quality"].to_numpy()
    return [parts[i] for i in order], np.array([1 if marks[i] else 0 for i in order], np.float32)


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """All columns of ``docs``, then the score (0 to 1, higher: label 1 likelier) as last column."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(net.parameters()))
    width, at = len(docs.columns), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*shared.value)
        for block in blocks(batches, limit=2 << 20):
            texts = [(t or "").encode() for t in block.column(at).to_pylist()]
            columns = [*[block.column(i) for i in range(width)], pa.array(net.score(texts), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*block.schema.names, SCORE])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())]))


def learnt(docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0) -> Network:
    """The network learnt from the labels outside the held-out fold."""
    labels = labels.select("doc_id", "quality").withColumn("fold", remainder("doc_id", divisor)).where(F.col("fold") != held_out)
    return fit(*sampled(docs, labels))


def judged(docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null or empty text: one chunk of zero bytes is scored. No labels, or one
    label only: all scores are equal. A document labelled twice counts as 1 if
    one label is 1. Null ids are scored, never learnt from. Repeated rows are
    scored alike. Empty table: no rows. Other columns are ignored.
    """
    net = learnt(docs, labels, divisor, held_out)
    rows = docs.select("doc_id", F.coalesce(remainder("doc_id", divisor) == held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    score = F.col(SCORE)
    return scored(rows, net).select("doc_id", "held_out", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; any column name may occur in ``docs``."""
    names = docs.columns
    rows = docs.toDF(*[name if name == "text" else f"c{i}" for i, name in enumerate(names)])
    kept = scored(rows, learnt(docs, labels)).where(F.col(SCORE) >= THRESHOLD)
    return kept.drop(SCORE).toDF(*names)
