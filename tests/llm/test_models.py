"""Classifiers, language models and the pipeline: brute force, held-out labels, hard rows."""

import itertools
import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quartermill.llm import langid, ngram_bloom, quality_cnn, toxicity
from quartermill.llm.common import table
from tests.llm.data import empty, hard, hard_rows, plain

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality network ----------------------------------------------------------------


def slow_score(net, text):
    """One text, chunk by chunk and window by window."""
    w, half, stride = quality_cnn.WIDTH, quality_cnn.HALF, quality_cnn.STRIDE
    halves = max(1, -(-len(text) // half))
    padded = text.ljust(halves * half, b"\0") + b"\0" * (2 * half)
    features = []
    for start in range(max(1, halves - 1)):
        size = half if halves == 1 else 2 * half
        peaks = []
        for at in range(start * half, start * half + size, stride):
            window = np.concatenate([net.embed[b] for b in padded[at : at + w]])
            peaks.append(window @ net.filters + net.bias)
        features.append(np.maximum(np.max(peaks, axis=0), 0))
    return float(net.probability(np.mean(features, axis=0)[None])[0])


def test_fast_scores_equal_slow_ones():
    net = quality_cnn.Network.fresh(3)
    texts = [b"", b"a", b"x" * 127, b"y" * 128, bytes(range(256)) * 3, "Größe 漢字".encode() * 40, b"z" * 129]
    fast = net.score(texts)
    assert fast == pytest.approx([slow_score(net, t) for t in texts], abs=1e-5)
    # A text's score does not depend on its neighbours.
    assert net.score(texts[4:5])[0] == pytest.approx(fast[4], abs=1e-6)
    assert len(net.score([])) == 0


def test_quality_of_held_out_documents(spark):
    labels = table(spark, SMALL, "labels")
    rows = quality_cnn.judged(table(spark, SMALL, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    assert right > 0.9


def test_quality_of_hard_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (1, 1, 0), (5, None, 0), (None, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    docs = hard(spark)
    got = quality_cnn.judged(docs, labels).collect()
    assert len(got) == len(hard_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_cnn.judged(docs, labels.limit(0)).count() == len(hard_rows())
    assert quality_cnn.judged(empty(spark), labels).count() == 0
    assert quality_cnn.accepted(docs, labels).columns == docs.columns


# --- toxicity -----------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    labels = table(spark, SMALL, "labels").withColumnRenamed("toxic", "label")
    docs = table(spark, SMALL, "documents")
    rows = toxicity.judged(docs, table(spark, SMALL, "labels")).join(labels, "doc_id").where("held_out and quality = 1").collect()
    caught = [r["toxic"] for r in rows if r["label"] == 1]
    wrong = [r["toxic"] for r in rows if r["label"] == 0]
    assert sum(caught) >= 0.6 * len(caught) and sum(wrong) <= 0.03 * len(wrong)


def test_later_links_use_earlier_probabilities():
    rng = np.random.default_rng(1)
    rows = []
    for n in range(600):
        ids = rng.integers(0, 5000, 30)
        mark = n % 4 == 0
        if mark:
            ids = np.concatenate([ids, toxicity.seed_ids(("idiot" if n % 8 else "stupid",))])
        rows.append((n % toxicity.FOLDS, np.unique(ids), int(mark)))
    chain = toxicity.fit(rows)
    assert chain.names == ["insult", "contempt", "toxic"]
    assert [len(w) - 1 - len(chain.features) for w in chain.weights] == [0, 1, 2]
    present = np.isin(chain.features, toxicity.seed_ids(("idiot",)))[None].astype(float)
    found = chain.probabilities(present)[0]
    assert found[0] > 0.5 and found[1] < 0.5 and found[2] > 0.5
    assert chain.probabilities(np.zeros((1, len(chain.features))))[0, 2] < 0.5


def test_toxicity_of_hard_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, None), (8, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.judged(hard(spark), labels).collect()
    assert len(got) == len(hard_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.judged(hard(spark), labels.limit(0)).where("toxic = 1").count() == 0
    assert toxicity.judged(empty(spark), labels).count() == 0


# --- language -----------------------------------------------------------------------


def segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def test_forward_sums_all_segmentations():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b" ab", b"bc", b"abc", b" abca", b"ca"})
    rng = np.random.default_rng(2)
    table_ = np.vstack([rng.random((len(pieces), 3)), np.zeros((1, 3))])
    model = langid.Model(["x", "y", "z"], pieces, table_)
    words = [b"abcabc", b"a", b"zz", "é".encode(), b"bcbcab", b""]
    got = np.exp(model.log_sums(langid.Lattice(pieces), words))
    number = {p: i for i, p in enumerate(pieces)}
    for word, sums in zip(words, got):
        brute = sum(np.prod([table_[number[p]] for p in s], axis=0) for s in segmentations(b" " + word, set(pieces)))
        assert sums == pytest.approx(brute)


def test_expected_counts_are_those_of_all_segmentations():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"bc", b" abc"})
    lattice, number = langid.Lattice(pieces), {p: i for i, p in enumerate(pieces)}
    rng = np.random.default_rng(6)
    table_ = rng.random((len(pieces), 2))
    words, counts = [b" abcab", b" bcz", b"a"], np.array([[3.0, 5.0], [1.0, 0.0], [2.0, 7.0]])
    got = lattice.expected(words, table_, counts)
    brute = np.zeros((len(pieces), 2))
    for word, n in zip(words, counts):
        weights = [(s, np.prod([table_[number[p]] for p in s], axis=0)) for s in segmentations(word, set(pieces))]
        total = sum(w for _, w in weights)
        for parts, w in weights:
            for p in parts:
                brute[number[p]] += w / total * n
    assert got == pytest.approx(brute)


def slow_log_sums(word, pieces, table_):
    """Logarithm of the sum over all segmentations by language, prefix by prefix in exact fractions of two powers."""
    number, longest = {p: i for i, p in enumerate(pieces)}, max(map(len, pieces))
    out = []
    for column in table_.T:
        sums = [Fraction(1)]
        for end in range(1, len(word) + 1):
            found = [(n, number.get(word[end - n : end])) for n in range(1, min(longest, end) + 1)]
            sums.append(sum(sums[end - n] * Fraction(float(column[i])) for n, i in found if i is not None))
        out.append(math.log(sums[-1].numerator) - math.log(sums[-1].denominator))
    return out


@pytest.mark.parametrize("step", [langid._STEP, 37])
def test_long_words_and_pieces_are_summed_whole(monkeypatch, step):
    """Words far over 48 bytes, pieces over 8 bytes, unseen scripts: nothing is cut, nothing underflows."""
    monkeypatch.setattr(langid, "_STEP", step)
    long_pieces = {b" international", b"ternational", b"nationalisation", "言語".encode() * 3, "ያልታወቀ".encode()}
    pieces = sorted({bytes([b]) for b in range(256)} | {b" in", b"ter", b"nation", b"al", b"isation"} | long_pieces)
    rng = np.random.default_rng(4)
    table_ = rng.random((len(pieces), 3)) * np.array([1e-2, 1e-6, 1e-9])
    model = langid.Model(["x", "y", "z"], pieces, table_)
    words = [b"internationalisation", b"internationalisation" * 6, ("言語" * 40).encode(), "𐌰𐌱ያልታወቀ".encode() * 9, b"q" * 200, b"a"]
    got = model.log_sums(langid.Lattice(pieces), words)
    for word, logs in zip(words, got):
        assert logs == pytest.approx(slow_log_sums(b" " + word, pieces, table_), rel=1e-9)


def test_whole_vocabulary_takes_part():
    pieces = langid.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, pieces)) > 20 and len(pieces) > 31_000
    lattice = langid.Lattice(pieces)
    long = [p for p in pieces if len(p) > 8]
    data = np.frombuffer(b"".join(long), np.uint8).astype(np.int64)
    ends = np.cumsum([len(p) for p in long])
    starts = ends - [len(p) for p in long]
    at, size, ids = lattice.hits(data, starts, ends)
    assert {(a, n) for a, n in zip(at.tolist(), size.tolist())} >= set(zip(starts.tolist(), (ends - starts).tolist()))
    assert all(pieces[i] == bytes(data[a : a + n].astype(np.uint8)) for a, n, i in zip(at, size, ids))


def test_long_words_are_learnt_from_end_to_end():
    word = "ж".encode() * 5_000
    parts = langid.learnt_from(word + b"z")
    assert len(parts) == langid.WORD_SPANS and parts[0][:1] == b" " and parts[-1][-1:] == b"z"
    assert all(len(p) <= langid.SPAN_BYTES + 6 and p.decode() for p in parts)
    assert langid.learnt_from(b"short") == [b" short"]


def test_sample_is_that_of_the_least_hashes(spark):
    docs = plain(spark, [(i, f"w{i} again", "s") for i in range(700)])
    found = langid.sample_counts(docs.repartition(5), per_language=40)["en"]
    order = [r[0] for r in docs.orderBy(F.xxhash64("doc_id")).select("doc_id").limit(40).collect()]
    assert {k for k in found if k != b" again"} == {f" w{i}".encode() for i in order} and found[b" again"] == 40


def test_language_of_held_out_documents(spark):
    docs = table(spark, SMALL, "documents")
    rows = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_language_of_hard_rows(spark):
    docs = hard(spark)
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.identified(docs).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (None, "und")} <= got
    assert langid.identified(docs).count() == len(hard_rows()) and langid.identified(empty(spark)).count() == 0
    nothing = langid.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


# --- n-gram scores ------------------------------------------------------------------


def slow_scores(rows, prior):
    """Exact counts instead of the filter's levels."""
    cut = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")] + ["\n"]
    one, two = Counter(), Counter()
    for text in rows["train"]:
        words = cut(text)
        one.update(words)
        two.update(zip(["\n", *words[:-1]], words))
    n, v = sum(one.values()), len(one)
    for text in rows["score"]:
        words = cut(text)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words)
        full = 0.0
        for before, word in zip(["\n", *words[:-1]], words):
            p = (one[word] + 1) / (n + v + 1)
            full += math.log10((min(two[before, word], one[before]) + prior * p) / (one[before] + prior))
        yield len(words), sum(one[w] > 0 for w in words), n, base, full


@pytest.mark.parametrize("max_words", [2_000_000, 40, 0])
def test_scores_match_exact_counts(spark, max_words):
    texts = [r[1] for r in hard_rows()] + [f"rare{i} common words here {i % 7} END" for i in range(60)]
    docs = plain(spark, [(i, t, "s") for i, t in enumerate(texts)])
    train = docs.where("doc_id % 3 <> 1")
    got = ngram_bloom.scored(docs, train, max_words=max_words, prior=5.0).orderBy("doc_id").collect()
    exact = slow_scores({"train": [t for i, t in enumerate(texts) if i % 3 != 1], "score": texts}, 5.0)
    for r, (n, known, total, base, full) in zip(got, exact):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base)
        # Counts are cut to levels: each token's probability is off by at most that.
        assert abs(r["score"] - full) <= 0.16 * n


def test_scores_of_hard_rows(spark):
    rows, train = ngram_bloom.trained_on(hard(spark))
    got = ngram_bloom.scored(rows, train, keep=("doc_id", "held_out")).collect()
    assert len(got) == len(hard_rows()) and all(r["score"] < 0 and r["base_score"] < 0 for r in got if r["n_tokens"] > 1)
    none = ngram_bloom.scored(rows, train.limit(0)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
    rows, train = ngram_bloom.trained_on(empty(spark))
    assert ngram_bloom.scored(rows, train).count() == 0


@pytest.mark.parametrize("buckets", [1, 5])
def test_filter_never_forgets_and_seldom_invents(buckets):
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64))
    counts = rng.geometric(0.3, len(keys)) ** 2
    levels = np.array([1 + math.floor(math.log(c) / math.log(ngram_bloom.BASE) + 1e-9) for c in counts])
    own = ngram_bloom.bucket_of(keys, buckets)
    assert (np.diff(own) >= 0).all() and set(own) == set(range(buckets))
    bloom = ngram_bloom.Filter.of({b: ngram_bloom.filled(keys[own == b], levels[own == b]) for b in range(buckets)}, buckets)
    got = bloom.levels(keys)
    assert (got >= levels).all() and (got > levels).mean() < 0.02
    assert (bloom.levels(rng.integers(0, 2**64, 20_000, dtype=np.uint64)) > 0).mean() < 0.02
    # A bucket without n-grams holds nothing.
    assert not ngram_bloom.Filter.of({}, buckets).levels(keys).any()


def test_keys_come_back_from_their_packed_form():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5_000):
        keys = np.unique(np.append(rng.integers(0, 2**64, n, dtype=np.uint64), [np.uint64(0), np.uint64(2**64 - 1)][: n % 3]))
        assert (ngram_bloom.unpacked(ngram_bloom.packed(keys), len(keys)) == keys).all()
    parts = [(np.array([1, 5, 9], np.uint64), np.array([1, 2, 3], np.uint32)), (np.array([5, 9], np.uint64), np.array([2**32 - 1, 1], np.uint32))]
    found, sums = ngram_bloom.summed(parts)
    assert found.tolist() == [1, 5, 9] and sums.tolist() == [1, 2**32 + 1, 4]


# --- pipeline -----------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents").where("doc_id < 400")
    names, frames = [n for n, _ in corpus_pipeline.STAGES], [docs]
    assert len(names) == 5
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, frames[-1], SMALL)
        assert out.columns == docs.columns
        frames.append(spark.createDataFrame(out.toArrow()))
    ids = [[r["doc_id"] for r in f.select("doc_id").collect()] for f in frames]
    for before, after in itertools.pairwise(ids):
        assert set(after) <= set(before) and after
    assert len(ids[1]) < len(ids[0]) and len(ids[3]) < len(ids[2])
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    clean = [i for i in ids[0] if labels.get(i) == 1]
    assert sum(i in set(ids[1]) for i in clean) >= 0.97 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, frames[-1], SMALL)
    from quartermill.llm import packing

    texts = Counter(ids[-1])
    lengths = {r["doc_id"]: len(packing.encode([r["text"]], packing.vocabulary())[0]) + 1 for r in frames[-1].collect()}
    got = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == {i: n * lengths[i] for i, n in texts.items()}


def test_pipeline_of_hard_rows(spark):
    docs = hard(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SMALL)
        assert out.columns == docs.columns
        out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty(spark), SMALL).count() == 0


# --- samples ------------------------------------------------------------------------


def test_samples_hold_one_row_of_a_repeated_id(spark):
    rows = [(1, f"text number {n // 2} of a repeated id", "s") for n in range(60)] + [(2, "another one", "s"), (3, None, "s"), (3, None, "s")]
    docs = plain(spark, rows)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    chunks, marks = quality_cnn.sampled(docs, labels)
    assert len(chunks) == 3 and marks.tolist() == [1, 0, 1]
    assert chunks == quality_cnn.sampled(docs.repartition(7), labels)[0]
    assert [mark for _, _, mark in toxicity.sampled(docs, labels)] == [0, 1, 0]
    counts = langid.sample_counts(docs)["en"]
    assert counts[b" repeated"] == 1 and counts[b" another"] == 1


# --- filters beyond the broadcast bound ----------------------------------------------


@pytest.mark.parametrize("block_bytes, bucket_bytes", [(4 << 20, 16 << 20), (700, 900)])
def test_scores_do_not_depend_on_the_broadcast_bound(spark, monkeypatch, block_bytes, bucket_bytes):
    monkeypatch.setattr(ngram_bloom, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(ngram_bloom, "BUCKET_BYTES", bucket_bytes)
    texts = [r[1] for r in hard_rows()] + [f"rare{i} common words here {i % 7} END" for i in range(60)]
    docs = plain(spark, [(i, t, "s") for i, t in enumerate(texts)]).withColumn("learnt", F.expr("doc_id % 3 <> 1"))
    train = docs.where("learnt")
    scores = [
        [tuple(r) for r in ngram_bloom.scored(docs, learn, max_bytes=b).orderBy("doc_id").collect()]
        for b in (ngram_bloom.MAX_FILTER_BYTES, 100)
        for learn in (train, "learnt")
    ]
    assert len(scores[0]) == len(texts)
    # Both ways to broadcast or shuffle give the same; the buckets of a separate table follow from both tables' texts.
    assert scores[0] == scores[2] and scores[1] == scores[3]
    assert [r[:-1] for r in scores[0]] == [r[:-1] for r in scores[1]]
    assert bucket_bytes < 1 << 20 or scores[0] == scores[1]
