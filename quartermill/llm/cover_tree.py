"""Exact top-k inner products by dual-tree search over cover trees."""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import joined
from quartermill.session import stage

K = 10
#: Bound of the sample that the top level's centres are chosen from, and of the centres.
SAMPLE, CENTRES = 4_096, 64
#: Rows of a cell's part, the unit of one tree; and of a leaf.
PART, LEAF = 2_048, 64
#: Scores that are cheaper to compute than to rule out; and candidates scored at once.
DIRECT, CHUNK = 8_192, 4_096


@dataclass
class Indexed:
    """A point matrix with its cover tree, rows in the tree's order.

    A node is the rows ``start`` to ``stop``, all within its radius of the
    first of them; its children are the nodes ``first`` to ``first + count``.
    """

    points: np.ndarray
    ids: np.ndarray
    nodes: np.ndarray  # start, stop, first, count
    radii: np.ndarray

    def __post_init__(self):
        self.lengths = np.linalg.norm(self.points[self.nodes[:, 0]], axis=1)
        self.largest = np.abs(self.points).max(initial=0.0)

    def below(self, node: int) -> np.ndarray:
        """Children of a node; a leaf stands for itself."""
        _, _, first, count = self.nodes[node]
        return np.arange(first, first + count) if count else np.array([node])


def build(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cover tree of the points: the rows in its order, nodes and radii (see ``Indexed``).

    Children cover a node with balls of at most half its radius. Centres are
    points, each next one the farthest from those before. Equal points end in
    one leaf of radius 0, however many there are.
    """
    order = np.arange(len(points))
    nodes, radii = [[0, len(points), 0, 0]], []
    for start, stop, *_ in nodes:  # grows while it is read
        rows = order[start:stop]
        gaps = np.linalg.norm(points[rows] - points[rows[0]], axis=1)
        radius = float(gaps.max(initial=0.0))
        here = len(radii)
        radii.append(radius)
        if len(rows) <= leaf or radius == 0:
            continue
        owner = np.zeros(len(rows), np.int64)
        count = 1
        while gaps.max() > radius / 2 and count < 16:
            far = int(gaps.argmax())
            new = np.linalg.norm(points[rows] - points[rows[far]], axis=1)
            closer = new < gaps
            gaps[closer], owner[closer] = new[closer], count
            owner[far], gaps[far] = count, 0.0
            count += 1
        # The node's centre comes first in its first child, so it stays the node's first row.
        order[start:stop] = rows[np.argsort(owner, kind="stable")]
        bounds = start + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))])
        filled = [[int(x), int(y), 0, 0] for x, y in zip(bounds, bounds[1:]) if y > x]
        nodes[here][2:] = [len(nodes), len(filled)]
        nodes.extend(filled)
    return order, np.array(nodes, np.int32), np.array(radii)


def indexed(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Indexed:
    order, nodes, radii = build(points, leaf)
    return Indexed(points[order], ids[order], nodes, radii)


class Best:
    """The k best (score, id) of each query: higher scores first, ties to smaller ids."""

    def __init__(self, queries: int, k: int, kind: type = np.longdouble):
        self.k = k
        # Long doubles hold every 64-bit integer.
        self.scores = np.full((queries, k), -np.inf, kind)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, np.int64)

    def worst(self, start: int, stop: int) -> float:
        return float(self.scores[start:stop, -1].min())

    def add(self, start: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` is (query, candidate) for the queries from ``start`` on."""
        least = self.scores[start : start + len(scores), -1]
        good = np.flatnonzero(scores.max(axis=1, initial=-np.inf) >= least)
        if not len(good):
            return
        least = least[good]
        if scores.shape[1] > 4 * self.k:
            # All that reach a query's kth score of these, ties included.
            least = np.maximum(least, np.partition(scores[good], -self.k, axis=1)[:, -self.k])
        for i, low in zip(good.tolist(), least):
            found = np.flatnonzero(scores[i] >= low)
            all_scores = np.concatenate([self.scores[start + i], scores[i, found]])
            all_ids = np.concatenate([self.ids[start + i], ids[found]])
            order = np.lexsort([all_ids, -all_scores])[: self.k]
            self.scores[start + i], self.ids[start + i] = all_scores[order], all_ids[order]


def number_kind(queries: Indexed, points: Indexed) -> type:
    """float64 where every partial sum of a product is exact in it, else long double."""
    return np.float64 if queries.largest * points.largest * max(1, points.points.shape[1]) < 2**53 else np.longdouble


def search(queries: Indexed, points: Indexed, best: Best) -> int:
    """Brings ``best`` (a row for each of the queries, in their order) up to date with the points; returns the number of scores computed.

    Pairs of nodes are visited in the order of their bound. For a query q in a
    ball (c, r) and a point p in a ball (d, s), q.p is at most c.d + |c| s +
    |d| r + r s. A pair whose bound is below every kth score of its queries is
    dropped. Where none of the pairs of children could be, or few scores are
    left, the pair is scored as one matrix product.
    """
    kind = number_kind(queries, points)
    left, right = queries.points.astype(kind, copy=False), points.points.astype(kind, copy=False)
    order, computed = 0, 0

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        c, d = queries.lengths[a][:, None], points.lengths[b][None, :]
        r, s = queries.radii[a][:, None], points.radii[b][None, :]
        highest = queries.points[queries.nodes[a, 0]] @ points.points[points.nodes[b, 0]].T + c * s + d * r + r * s
        return highest + 1e-9 * (c * d + np.abs(highest) + 1.0)

    heap = [(-np.inf, order, 0, 0)]
    while heap:
        low, _, a, b = heapq.heappop(heap)
        (start, stop), (first, last) = queries.nodes[a, :2], points.nodes[b, :2]
        if -low < best.worst(start, stop):
            continue
        children = queries.below(a), points.below(b)
        small = (stop - start) * (last - first) <= DIRECT or len(children[0]) == len(children[1]) == 1
        if not small:
            values = bounds(*children)
            worst = np.array([best.worst(*queries.nodes[x, :2]) for x in children[0]])
            kept = values >= worst[:, None]
            small = kept.all() and worst.min() > -np.inf
        if small:
            for at in range(first, last, CHUNK):
                end = min(last, at + CHUNK)
                scores = left[start:stop] @ right[at:end].T
                scores[queries.ids[start:stop, None] == points.ids[None, at:end]] = -np.inf
                computed += scores.size
                best.add(start, scores, points.ids[at:end])
            continue
        for i, j in np.argwhere(kept).tolist():
            order += 1
            heapq.heappush(heap, (-values[i, j], order, int(children[0][i]), int(children[1][j])))
    return computed


def vectors(df: DataFrame, scale: int = 1024, copies: int | None = None) -> DataFrame:
    """vec_id, v (floor(scale * x) of every component) and dim, of the rows that take part.

    One row an id, or every row if ``copies`` is given: of rows with equal id
    and vector at most so many, for no more of them can be among the best.
    """
    x = F.col("embedding")
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    unfit = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(~unfit).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    if copies is None:
        return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    rows = rows.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(copies)).alias("n"))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("n")).drop("n")


def top_centres(rows: DataFrame, sample: int = SAMPLE, most: int = CENTRES) -> dict[int, np.ndarray]:
    """Centres of the top level by dimension, farthest first, from a bounded sample in hash order."""
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("dim", "v").collect()
    out = {}
    for dim in {r["dim"] for r in found}:
        own = [r["v"] for r in found if r["dim"] == dim]
        points = np.array(own, np.float64).reshape(len(own), dim)
        chosen, gaps = [0], np.linalg.norm(points - points[0], axis=1)
        while len(chosen) < most and gaps.max() > 0:
            chosen.append(int(gaps.argmax()))
            gaps = np.minimum(gaps, np.linalg.norm(points - points[chosen[-1]], axis=1))
        out[dim] = points[chosen]
    return out


def _matrix(values: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(values, "<f4" if len(values) == 4 * dim * rows else "<f8").astype(np.float64).reshape(rows, dim)


def _pack(matrix: np.ndarray) -> bytes:
    return matrix.astype("<f4" if np.abs(matrix).max(initial=0) < 1 << 24 else "<f8").tobytes()


def in_cells(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cell``, the nearest centre, to vec_id, dim, v. A dimension without centres is one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int32)
            lists = batch.column("v")
            for dim, points in centres.items():
                own = np.flatnonzero(dims == dim)
                for low in range(0, len(own), 1024):
                    some = own[low : low + 1024]
                    v = np.asarray(lists.take(pa.array(some)).flatten()).reshape(len(some), dim)
                    cell[some] = ((points**2).sum(1) - 2 * v @ points.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("dim"), lists, pa.array(cell)], ["vec_id", "dim", "v", "cell"])

    return rows.select("vec_id", "dim", "v").mapInArrow(run, "vec_id long, dim int, v array<double>, cell int")


def in_parts(rows: DataFrame, size: int = PART) -> DataFrame:
    """One row for each part of a cell: dim, cell, part, n, ids, matrix, centre, radius, and its tree (nodes, radii).

    A cell is cut into parts of about ``size`` rows by a hash of id and vector,
    so a cell of equal vectors or of one id is cut as well.
    """
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    rows = joined(rows, parts, ["dim", "cell"])
    rows = rows.withColumn("part", F.expr("pmod(xxhash64(vec_id, v), parts)").cast("int")).select("dim", "cell", "part", "vec_id", "v")

    def gather(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(group))
        dim, cell, part = (table[c][0].as_py() for c in ("dim", "cell", "part"))
        points = np.asarray(table["v"].combine_chunks().flatten()).reshape(table.num_rows, dim)
        ids = table["vec_id"].to_numpy()
        tree = indexed(points, ids)
        values = [dim, cell, part, len(ids), tree.ids.astype("<i8").tobytes(), _pack(tree.points), tree.points[0].tolist(), float(tree.radii[0])]
        values += [tree.nodes.astype("<i4").tobytes(), tree.radii.astype("<f8").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _PART_TYPES)], _PART_NAMES)

    return rows.groupBy("dim", "cell", "part").applyInArrow(gather, _PART_SCHEMA)


_PART_NAMES = ["dim", "cell", "part", "n", "ids", "matrix", "centre", "radius", "nodes", "radii"]
_PART_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64(), pa.binary(), pa.binary()]
#: What a comparison reads of a part.
SIDE = ("n", "ids", "matrix", "nodes", "radii")
_PART_SCHEMA = "dim int, cell int, part int, n int, ids binary, matrix binary, centre array<double>, radius double, nodes binary, radii binary"


def compare(pairs: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score of each query part's best in one part of the candidates.

    ``pairs`` has the columns of ``SIDE`` of both sides, with q_ for the query
    part, dim, and known (worst kth score of the query part so far, null for
    none). The trees come with the parts.
    """

    def part(row: dict, prefix: str) -> Indexed:
        ids, matrix, n = (row[prefix + c] for c in ("ids", "matrix", "n"))
        nodes = np.frombuffer(row[prefix + "nodes"], "<i4").reshape(-1, 4)
        return Indexed(_matrix(matrix, row["dim"], n), np.frombuffer(ids, "<i8"), nodes, np.frombuffer(row[prefix + "radii"], "<f8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                queries, points = part(row, "q_"), part(row, "")
                best = Best(len(queries.ids), k, number_kind(queries, points))
                if row["known"] is not None:
                    # A score below every query's kth one so far can't be among the results.
                    best.scores[:] = best.scores.dtype.type(row["known"]) - 1
                search(queries, points, best)
                real = (best.ids != np.iinfo(np.int64).max) & (best.scores > -np.inf)
                found = best.scores[real].astype(np.longdouble)
                scores = np.clip(found, -(np.longdouble(2) ** 63), np.longdouble(2) ** 63 - 1).astype(np.int64)
                columns = [np.broadcast_to(queries.ids[:, None], real.shape)[real], best.ids[real], scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, is_query: Column, k: int = K, part: int = PART, every_row: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of every query, ties to smaller ids.

    Rows are dealt to the cells of a top tree level whose centres come from a
    bounded sample; every row is indexed. Query parts and candidate parts are
    matrices of bounded size. A query part first searches one part of its own
    cell; its worst kth score then drops all cells whose bound, from both
    radii, lies below. The pairs left are searched by dual trees, which are
    built once and kept with their parts.

    Null ids, null vectors and vectors that hold null or non-finite components
    take no part. Of several rows with one id the least vector counts, or
    with ``every_row`` each: candidates are all rows of other ids, and the best
    of all rows of a query's id are ranked together. Vectors of different length never meet; of length 0 all scores are 0. Fewer than k
    candidates: all of them. Empty table: no rows. Other columns are ignored.
    """
    rows = vectors(df, copies=k if every_row else None)
    rows = stage(in_cells(rows, top_centres(rows)), "vectors")
    parts = stage(in_parts(rows, part), "candidate-parts")
    queries = in_parts(rows.where(is_query), part // 2)
    queries = queries.select("dim", "cell", *[F.col(c).alias(f"q_{c}") for c in _PART_NAMES[2:]])
    queries = stage(queries, "query-parts")
    first = queries.join(parts.where("part = 0"), ["dim", "cell"])
    sides = [*[f"q_{c}" for c in SIDE], *SIDE, "dim", "known"]
    first = stage(compare(first.withColumn("known", F.lit(None).cast("long")).select(sides), k), "first-scores")
    # The kth score of each query so far, the least of them for each query part.
    ranked = first.withColumn("rank", F.row_number().over(_order()))
    kth = ranked.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    owners = queries.select("dim", "cell", "q_part", F.explode(F.expr("sequence(0, q_n - 1)")).alias("i"), "q_ids")
    owners = owners.select("dim", "cell", "q_part", F.expr("conv(hex(reverse(substring(q_ids, 8 * i + 1, 8))), 16, -10)").cast("long").alias("query_id"))
    known = owners.join(kth, "query_id", "left").groupBy("dim", "cell", "q_part")
    known = known.agg(F.when(F.count("kth") == F.count(F.lit(1)), F.min("kth")).alias("known"))
    queries = queries.join(known, ["dim", "cell", "q_part"])
    # A cell's ball holds those of its parts; there are at most CENTRES cells a dimension.
    spread = F.aggregate(F.zip_with("centre", "mid", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    mids = parts.where("part = 0").select("dim", "cell", F.col("centre").alias("mid"))
    cells = parts.select("dim", "cell", "centre", "radius").join(mids, ["dim", "cell"])
    cells = cells.groupBy("dim", "cell", "mid").agg(F.max(F.sqrt(spread) + F.col("radius")).alias("reach"))
    own_cells = cells.groupBy("dim").agg(F.collect_list(F.struct("cell", "mid", "reach")).alias("cells"))
    pairs = queries.join(own_cells, "dim").withColumn("c", F.explode("cells")).drop("cells")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    c, d = F.sqrt(dot("q_centre", "q_centre")), F.sqrt(dot("c.mid", "c.mid"))
    q_r, p_r = F.col("q_radius"), F.col("c.reach")
    highest = dot("q_centre", "c.mid") + c * p_r + d * q_r + q_r * p_r
    highest = highest + 1e-9 * (c * d + F.abs(highest) + 1.0)
    pairs = pairs.where(F.col("known").isNull() | (highest >= F.col("known")))
    pairs = pairs.withColumnRenamed("cell", "q_cell").withColumn("cell", F.col("c.cell")).drop("c")
    pairs = pairs.join(parts, ["dim", "cell"]).where(~((F.col("cell") == F.col("q_cell")) & (F.col("part") == 0)))
    rest = compare(pairs.select(sides), k)
    out = first.unionByName(rest).withColumn("rank", F.row_number().over(_order()))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _order():
    return Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
