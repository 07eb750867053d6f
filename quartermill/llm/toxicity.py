"""Toxicity by a classifier chain of linear models over words."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import one_row_each, remainder
from quartermill.llm.textbatch import NOT_LETTER, Words, blocks

#: Categories in the order of the chain, with seed words. A labelled toxic
#: document is of a category if it holds one of its seeds; the last link of the
#: chain, ``toxic``, is the label itself.
CATEGORIES = {
    "insult": ("idiot", "moron", "loser", "clown", "scum"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "trash"),
}
LAST = "toxic"
#: Words and word beginnings of PREFIX bytes are hashed to this many features.
FEATURES, PREFIX = 1 << 20, 8
#: Bound of the labelled sample, and of the features that may carry weight.
SAMPLE_DOCS, MOST_FEATURES = 8_000, 2_000
#: A feature must be in so many toxic documents, and so surely more often there.
LEAST_DOCS, LEAST_Z = 4, 4.5
FOLDS, EPOCHS, RATE, DECAY = 3, 200, 0.5, 1e-4
THRESHOLD = 0.5


def feature_ids(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every letter run and its beginning, in lower case."""
    words = Words(block.column("text"), lower=True, separators=NOT_LETTER)
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    view, digest = memoryview(words.data), xxhash.xxh64_intdigest
    bounds = list(zip(words.starts.tolist(), words.ends.tolist()))
    whole = np.array([digest(view[a:b]) for a, b in bounds], np.uint64)
    long = np.flatnonzero(words.ends - words.starts > PREFIX)
    start = np.array([digest(view[bounds[i][0] : bounds[i][0] + PREFIX], 1) for i in long], np.uint64)
    ids = (np.concatenate([whole, start]) % np.uint64(FEATURES)).astype(np.int64)
    return np.concatenate([owner, owner[long]]), ids


def seed_ids(seeds) -> list[int]:
    return [xxhash.xxh64_intdigest(s.encode()) % FEATURES for s in seeds]


@dataclass
class Chain:
    """Linear models in order; a model's inputs are the features and the earlier models' probabilities."""

    names: list[str]
    features: np.ndarray
    weights: list[np.ndarray]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        """Probability of each category, in order, of rows of feature flags."""
        out = np.zeros((len(present), len(self.names)))
        for i, weight in enumerate(self.weights):
            out[:, i] = linear(np.hstack([present, out[:, :i]]), weight)
        return out


def linear(inputs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(inputs @ weight[:-1] + weight[-1], -30, 30)))


def fit_linear(inputs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Logistic regression by full-batch gradient steps; classes weigh the same, all-equal targets give a constant."""
    weight = np.zeros(inputs.shape[1] + 1)
    if not len(target) or target.min() == target.max():
        weight[-1] = 10.0 if len(target) and target[0] else -10.0
        return weight
    balance = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    pace = np.full(len(weight), 1e-8)
    for _ in range(EPOCHS):
        error = balance * (linear(inputs, weight) - target) / len(target)
        slope = np.append(inputs.T @ error + DECAY * weight[:-1], error.sum())
        pace += slope * slope
        weight -= RATE * slope / np.sqrt(pace)
    return weight


def fit(rows: list[tuple[int, np.ndarray, int]], categories: dict = CATEGORIES) -> Chain:
    """The chain from (fold, feature ids, toxic) rows.

    Later models learn from the earlier models' predictions for folds that
    those had not seen, so they meet the same kind of input as when scoring.
    Features are words that are surely more frequent in toxic documents.
    """
    names = [*categories, LAST]
    toxic = np.array([t for _, _, t in rows], float)
    folds = np.array([f for f, _, _ in rows], int)
    in_toxic, in_all = np.zeros(FEATURES), np.zeros(FEATURES)
    for _, ids, mark in rows:
        in_all[ids] += 1
        in_toxic[ids] += mark
    expected = in_all * (toxic.mean() if len(toxic) else 0)
    surely = (in_toxic - expected) / np.sqrt(expected + 0.5)
    good = np.flatnonzero((in_toxic >= LEAST_DOCS) & (surely >= LEAST_Z))
    features = np.sort(good[np.argsort(-surely[good], kind="stable")][:MOST_FEATURES])
    present = np.zeros((len(rows), len(features)))
    targets = np.zeros((len(rows), len(names)))
    for i, (_, ids, mark) in enumerate(rows):
        present[i, np.flatnonzero(np.isin(features, ids))] = 1
        targets[i] = [mark and bool(np.isin(seed_ids(seeds), ids).any()) for seeds in categories.values()] + [mark]
    weights, unseen = [], np.zeros_like(targets)
    for k in range(len(names)):
        inputs = np.hstack([present, unseen[:, :k]])
        for fold in range(FOLDS):
            rest, own = folds != fold, folds == fold
            if own.any():
                unseen[own, k] = linear(inputs[own], fit_linear(inputs[rest], targets[rest, k]))
        weights.append(fit_linear(inputs, targets[:, k]))
    return Chain(names, features, weights)


def sampled(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> list[tuple[int, np.ndarray, int]]:
    """(fold, feature ids, toxic) of at most ``most`` labelled documents, chosen by a hash of the id.

    Of rows that share an id one counts, that of the least text hash. Whole texts are read; a row that reaches the driver holds at most FEATURES numbers.
    """
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = chosen.withColumn("fold", remainder("doc_id", FOLDS)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            owner, ids = feature_ids(block)
            both = np.unique(owner * FEATURES + ids)
            ends = np.searchsorted(both, np.arange(block.num_rows + 1) * FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((both % FEATURES).astype(np.int32)))
            columns = [block.column(n) for n in ("doc_id", "fold", "toxic")]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "fold", "toxic", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = one_row_each(rows, chosen, ["doc_id"]).select("doc_id", F.col("fold").cast("long").alias("fold"), "toxic", "text")
    found = rows.mapInArrow(run, "doc_id long, fold long, toxic int, ids array<int>").toArrow().combine_chunks()
    lists = [np.asarray(x.values) for x in found["ids"]]
    folds, marks, names = (found[c].to_pylist() for c in ("fold", "toxic", "doc_id"))
    return [(folds[i], lists[i], int(marks[i] != 0)) for i in sorted(range(len(lists)), key=lambda i: names[i])]


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, score, toxic (1 if score >= THRESHOLD) and p_<category> of every row of ``docs``.

    Null or empty text: no feature is present. Null ids are scored. Repeated
    rows are scored alike. Empty table: no rows. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((chain.names, chain.features, chain.weights))
    names = chain.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*shared.value)
        place = np.full(FEATURES, -1, np.int64)
        place[chain.features] = np.arange(len(chain.features))
        for block in blocks(batches):
            owner, ids = feature_ids(block)
            at = place[ids]
            present = np.zeros((block.num_rows, len(chain.features)))
            present[owner[at >= 0], at[at >= 0]] = 1
            found = chain.probabilities(present)
            columns = [block.column("doc_id"), pa.array(found[:, -1]), pa.array((found[:, -1] >= THRESHOLD).astype(np.int32))]
            columns += [pa.array(found[:, i]) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "toxic", *[f"p_{n}" for n in names[:-1]]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    extra = "".join(f", p_{n} double" for n in names[:-1])
    return rows.mapInArrow(run, f"doc_id long, score double, toxic int{extra}")


def judged(docs: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0) -> DataFrame:
    """``scored`` with held_out, learnt from the labels outside that fold; no labels: all scores are near 0."""
    train = labels.select("doc_id", "toxic").where(remainder("doc_id", divisor) != held_out)
    rows = scored(docs, fit(sampled(docs, train)))
    return rows.withColumn("held_out", F.coalesce(remainder("doc_id", divisor) == held_out, F.lit(False)))
