"""Exact top-k against a full scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int, part int, cell int"


def expected(rows, k, step=100):
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(1024 * float(np.float32(x)))) for x in v]
            fit[i] = min(fit.get(i, whole), whole)
    out = []
    for q, a in fit.items():
        if q % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fit.items() if i != q and len(b) == len(a))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k=10, step=100, **options):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in cover_tree.top_k(df, F.col("vec_id") % step == 0, k, **options).collect())


@pytest.mark.parametrize("part", [2048, 64])
def test_top_k_of_clusters_and_equal_vectors(spark, part):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1, 8)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 1000)]
    assert found(spark, rows, part=part) == expected(rows, 10)


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 2.0])]
    rows += [(100, [1.0, 2.0, 3.0]), (101, [0.5, 0.5, 0.5]), (200, []), (201, []), (6, [-1.0, 0.0003]), (6, [2.0, 2.0]), (6, [2.0, 2.0])]
    rows += [(300, [1e6, 1e6, 1e6, 1e6]), (301, [1e6, 1e6, 1e6, 1e6 + 1])]
    assert found(spark, rows) == expected(rows, 10)
    assert found(spark, []) == []


def test_search_prunes(spark):
    rng = np.random.default_rng(2)
    points = np.floor(np.concatenate([rng.normal(c, 0.5, (500, 4)) * 100 for c in (0, 10, 20, 30)]))
    ids = np.arange(len(points))
    queries = points[1500:1532]
    best = cover_tree.Best(32, 5)
    tree = cover_tree.indexed(queries, ids[1500:1532])
    computed = cover_tree.search(tree, cover_tree.indexed(points, ids), best)
    exact = tree.points @ points.T
    exact[np.arange(32), tree.ids] = -np.inf
    assert (np.sort(exact, axis=1)[:, ::-1][:, :5] == best.scores).all()
    assert computed < 0.5 * exact.size


def test_tree_covers_its_points():
    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(0, 1000, (600, 6)))
    tree = cover_tree.indexed(points, np.arange(len(points)))
    assert sorted(tree.ids.tolist()) == list(range(len(points)))
    for (start, stop, first, count), radius in zip(tree.nodes.tolist(), tree.radii):
        gaps = np.linalg.norm(tree.points[start:stop] - tree.points[start], axis=1)
        assert gaps.max() <= radius + 1e-6
        below = tree.nodes[first : first + count, :2].tolist()
        assert not below or [start, *[y for _, y in below]] == [*[x for x, _ in below], stop]


def test_query_equals_its_sql_on_repeated_ids(spark, tmp_path):
    import duckdb

    from quartermill.llm.queries import ORACLES, QUERIES

    rng = np.random.default_rng(7)
    rows = [(int(i), rng.normal(0, 1, 4).astype(np.float32).tolist(), 0, 1, 2) for i in rng.integers(0, 250, 900)]
    rows += [(5, [4.0, 4.0, 4.0, 4.0], 0, 1, 2)] * 30 + [(100, [1.0, 1.0, 1.0, 1.0], 0, 1, 2)] * 15
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in QUERIES["op5_cover_tree_top_k"](spark, str(tmp_path)).collect())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got and got == sorted(duck.sql(ORACLES["op5_cover_tree_top_k"]).fetchall())
