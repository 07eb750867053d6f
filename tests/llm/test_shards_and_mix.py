"""Sharding, curriculum mix and packing against brute force."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from quartermill.llm import mixture, packing, sharding
from tests.llm.data import empty, hard, hard_rows, plain


def seeded(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<q", value) if isinstance(value, int) else value, seed)


def owner(key, weights):
    """XXH64 of the key, then of the shard as an int seeded by it, as the SQL function chains them."""
    best = None
    for shard, weight in enumerate(weights):
        h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        h = int_hash(shard, h)
        draw = -math.log(((h >> 11) + 0.5) / 2.0**53) / weight
        best = min(best or (draw, shard), (draw, shard))
    return best[1]


def int_hash(value, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed)


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 3.0, 0.5]])
def test_shards_follow_the_key_alone(spark, weights):
    docs = hard(spark)
    got = sharding.shard_rows(docs, weights).collect()
    assert len(got) == len(hard_rows())
    slots = defaultdict(list)
    for r in got:
        assert r["shard"] == owner(r["doc_id"], weights)
        assert r["grown_shard"] in (r["shard"], len(weights))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_text = sorted((r[0] is None, r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in hard_rows())
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in got) == by_text


def test_shards_share_by_weight_and_move_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    rows = sharding.shard_rows(docs, [1.0, 2.0, 1.0], 1.0).groupBy("shard", "grown_shard").count().collect()
    share = sum(r["count"] for r in rows if r["shard"] == 1) / 20_000
    moved = sum(r["count"] for r in rows if r["grown_shard"] == 3) / 20_000
    assert abs(share - 0.5) < 0.02 and abs(moved - 0.2) < 0.02
    assert sharding.shard_rows(empty(spark)).count() == 0


def filled(sizes, weights, most=3.0):
    """Targets by sharing again and again, source by source."""
    total, stopped = float(sum(sizes)), set()
    while True:
        rest = total - sum(most * sizes[i] for i in stopped)
        open_ = [i for i in range(len(sizes)) if i not in stopped]
        share = rest / sum(weights[i] for i in open_) if open_ else 0.0
        over = {i for i in open_ if weights[i] * share >= most * sizes[i]}
        if not over:
            return [most * s if i in stopped else weights[i] * share for i, s in enumerate(sizes)]
        stopped |= over


def test_mix_of_hard_rows(spark):
    docs = hard(spark)
    rows = mixture.plan(docs).collect()
    assert sorted(repr((r["doc_id"], r["size"])) for r in rows) == sorted(repr((r[0], len((r[1] or "").encode().split()))) for r in hard_rows())
    for r in rows:
        assert len(r["positions"]) == r["copies"] and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert all(0 <= p <= 1 for p in r["positions"])
    assert sorted(map(repr, rows)) == sorted(map(repr, mixture.plan(docs.repartition(5)).collect()))
    assert mixture.mix(docs).count() == sum(r["copies"] for r in rows)
    assert mixture.mix(docs).columns == docs.columns
    assert mixture.plan(empty(spark)).count() == 0 and mixture.mix(empty(spark)).count() == 0


def test_mix_order_of_repeated_ids_does_not_depend_on_partitions(spark):
    rows = [(7, f"same size text {n // 2}", "s") for n in range(40)] + [(n, f"another text here {n}", "t") for n in range(8, 60)]
    docs = plain(spark, rows)
    orders = [[tuple(r) for r in mixture.mix(docs.repartition(n, "text")).collect()] for n in (1, 3, 7)]
    assert orders[0] == orders[1] == orders[2]
    # Every text of the id takes part, as often as its rows.
    planned = mixture.plan(docs)
    assert len(orders[0]) == planned.agg({"copies": "sum"}).first()[0]
    found = Counter(r[1] for r in orders[0] if r[0] == 7)
    each = sorted(r["copies"] for r in planned.where("doc_id = 7").collect())
    assert sum(found.values()) == sum(each) and (each[0] == 0 or len(found) == 20)


def test_targets_and_taken_words(spark):
    rng = np.random.default_rng(3)
    counts = {"s0": 900, "s1": 300, "s2": 40, "s3": 5, None: 60}
    rows, n = [], 0
    for source, documents in counts.items():
        for _ in range(documents):
            rows.append((n, "w " * int(rng.integers(1, 60)), source))
            n += 1
    got = mixture.plan(plain(spark, rows)).collect()
    sizes = {s: sum(len(t.split()) for _, t, o in rows if o == s) for s in counts}
    order = ["s0", "s1", "s2", "s3", None]
    targets = filled([sizes[s] for s in order], [5, 2, 1, 5, 2])
    for source, target in zip(order, targets):
        own = [r for r in got if r["source"] == source]
        assert own[0]["source_size"] == sizes[source]
        assert own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= 60
    taken = [p for r in got for p in r["positions"] if r["source"] == "s0"]
    # The first kind of source fades: most of it comes early.
    assert sum(p < 0.5 for p in taken) / len(taken) == pytest.approx(0.625, abs=0.03)


@pytest.mark.parametrize("schedule", [((0, 2.0), (1, 0.0)), ((0, 0.0), (0.5, 1.0), (1, 1.0)), ((0, 1.0), (0.3, 1.0), (0.3, 3.0), (1, 0.5))])
def test_time_inverts_the_integral(spark, schedule):
    from pyspark.sql import functions as F

    grid = np.linspace(0, 1, 200_001)
    weight = np.interp(grid, [t for t, _ in schedule], [w for _, w in schedule])
    area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)]) * (grid[1] - grid[0])
    shares = [0.01, 0.2, 0.5, 0.77, 0.99]
    df = spark.createDataFrame([(s,) for s in shares], "q double").select(mixture.time_of(F.col("q"), schedule).alias("t"))
    for share, row in zip(shares, df.collect()):
        assert row["t"] == pytest.approx(np.interp(share * area[-1], area, grid), abs=2e-3)


def exact_ids(texts):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.vocabulary()[0]).encode_batch(texts, add_special_tokens=False)
    return [x.ids + [1] for x in found]


def check_packing(docs, window, **options):
    pieces = packing.packed(docs, window=window, **options).collect()
    rows = docs.select("doc_id", "text").collect()
    expected = sorted(repr((r["doc_id"], ids)) for r, ids in zip(rows, exact_ids([r["text"] or "" for r in rows])))
    lanes = defaultdict(list)
    for p in pieces:
        ids = np.array(p["ids"], "<u4")
        assert len(ids) == p["length"] and zlib.crc32(ids.tobytes()) == p["ids_crc32"]
        lanes[p["sequence_id"]].append((p["offset"], p["length"]))
    for lane in lanes.values():
        end = 0
        for offset, length in sorted(lane):
            assert offset == end
            end += length
        assert end <= window
    full = sum(sum(n for _, n in lane) == window for lane in lanes.values())
    assert full >= len(lanes) - 1
    # Every document is whole again when its pieces are laid end to end.
    left = sorted(pieces, key=lambda p: (repr(p["doc_id"]), p["doc_tokens"], p["start"]))
    if len({r["doc_id"] for r in rows}) == len(rows):
        by_doc = defaultdict(list)
        for p in left:
            by_doc[p["doc_id"]].append(p)
        again = []
        for doc, own in by_doc.items():
            ids = []
            for p in own:
                assert p["start"] == len(ids)
                ids += p["ids"]
            assert len(ids) == own[0]["doc_tokens"]
            again.append(repr((doc, ids)))
        assert sorted(again) == expected
    assert sum(p["length"] for p in pieces) == sum(len(eval(e)[1]) for e in expected)
    return pieces


def test_packing_hard_rows(spark):
    check_packing(hard(spark), 64, packet=16)
    check_packing(hard(spark).where("doc_id is not null").dropDuplicates(["doc_id"]), 64, packet=16)
    assert packing.packed(empty(spark)).count() == 0


def test_every_window_holds_the_source_shares(spark):
    rows = [(i, " ".join(["alpha beta gamma"] * (5 + i % 40)), f"s{0 if i % 3 else i % 5}") for i in range(400)]
    pieces = check_packing(plain(spark, rows), 512, packet=32)
    total, by_source, windows = 0, defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        total += p["length"]
        by_source[p["source"]] += p["length"]
        windows[p["sequence_id"]][p["source"]] += p["length"]
    assert len(windows) > 20
    for n, window in windows.items():
        if sum(window.values()) == 512:
            for source, ids in by_source.items():
                # At most the packets cut at both ends are missing or too many.
                assert abs(window[source] - 512 * ids / total) <= 2 * 32 + len(by_source) * 32


def test_given_weights_hold_while_all_queues_last(spark):
    rows = [(i, "alpha beta gamma delta " * 20, "ab"[i % 2]) for i in range(200)]
    pieces = packing.packed(plain(spark, rows), {"a": 3.0, "b": 1.0}, window=512, packet=32).collect()
    early = [p for p in pieces if p["sequence_id"] < 10]
    share = sum(p["length"] for p in early if p["source"] == "a") / sum(p["length"] for p in early)
    assert share == pytest.approx(0.75, abs=0.03)


@pytest.mark.parametrize("written", [True, False])
def test_packing_follows_the_curriculum(spark, written, tmp_path):
    import corpus_pipeline

    rows = [(i, f"alpha beta gamma {i} " * (20 + i % 50), f"s{i % 3}") for i in range(1500)]
    mixed = corpus_pipeline.mix(spark, plain(spark, rows), "")
    if written:
        mixed.write.parquet(str(tmp_path / "mix"))
        mixed = spark.read.parquet(str(tmp_path / "mix"))
    else:
        mixed = spark.createDataFrame(mixed.toArrow())
    pieces = corpus_pipeline.pack(spark, mixed, "").select("source", "sequence_id", "length").collect()
    last = max(p["sequence_id"] for p in pieces)
    assert last > 60
    halves = [defaultdict(int), defaultdict(int)]
    for p in pieces:
        halves[2 * p["sequence_id"] > last][p["source"]] += p["length"]
    share = {s: halves[0][s] / (halves[0][s] + halves[1][s]) for s in ("s0", "s1", "s2")}
    # The first source fades (5/8 of it in the first half of the time), the third grows.
    assert share["s0"] > share["s1"] + 0.05 > share["s2"] + 0.1
    check_packing(mixed, 512, packet=32, order=packing.row_order(mixed))
