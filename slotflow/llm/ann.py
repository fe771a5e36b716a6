"""Approximate nearest neighbours by stable projections and kd-trees with a chi-square test.

Vectors are scaled to length 1 (the largest cosine is then the smallest distance) and projected
to ``DIMS`` dimensions by a Gaussian matrix. The squared projected distance of two vectors,
divided by their squared distance, is chi-square distributed with DIMS degrees of freedom. A
query walks the projected space outward and verifies candidates by their true distance; once the
next projected distance r and the k-th best true distance d give chi2(r^2 / d^2) > ``STOP``, a
nearer vector is left out with a probability of at most 1 - STOP, and the walk ends.

The projected space is cut by a kd-tree whose upper splits are fitted on at most ``SAMPLE`` rows
(all rows are indexed); each upper cell is a partition with a kd-tree of its own. A query first
searches its own cell, which gives a k-th distance, then only the cells whose box passes the
test. Queries go to a cell in blocks of ``QUERY_BLOCK``.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
whose number of components is not the most frequent one. Rows with a null vec_id take no part;
repeated rows count once. Of equal vectors only the k + 1 with the smallest vec_id are indexed:
ties go to the smaller vec_id, so no other can be among a query's k nearest.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotflow.llm.common import stage
from slotflow.llm.hashing import spread

DIMS = 8
STOP = 0.98
SAMPLE = 20_000
CELL_ROWS = 20_000
MAX_CELLS = 8192
LEAF_ROWS = 32
QUERY_BLOCK = 4096
_SEED = 5


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi2_dims <= x) = p, for an even number of dimensions."""
    terms = range(dims // 2)
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in terms)
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def _project(vectors: np.ndarray, dims: int) -> np.ndarray:
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    return unit @ np.random.default_rng(_SEED).standard_normal((vectors.shape[1], dims))


# ------------------------------------------------------------------ upper kd-tree
def fit_cells(points: np.ndarray, n_cells: int) -> list[tuple[int, float]]:
    """Splits of a complete kd-tree with n_cells (a power of 2) leaves, in heap order."""
    groups, splits = [points], []
    while len(groups) < n_cells:
        below = []
        for g in groups:
            if len(g) < 2:
                splits.append((0, 0.0))
                below += [g, g[:0]]
                continue
            axis = int(np.argmax(g.max(0) - g.min(0)))
            at = float(np.median(g[:, axis]))
            splits.append((axis, at))
            below += [g[g[:, axis] <= at], g[g[:, axis] > at]]
        groups = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for _ in range(int(math.log2(len(splits) + 1))):
        axis = np.array([s[0] for s in splits])[node]
        at = np.array([s[1] for s in splits])[node]
        node = 2 * node + 1 + (points[np.arange(len(points)), axis] > at)
    return node - len(splits)


# ------------------------------------------------------------------ kd-tree of a cell
class Tree:
    """Leaves of at most ``LEAF_ROWS`` points with their boxes, from median splits."""

    def __init__(self, points: np.ndarray):
        self.points, leaves, todo = points, [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            spread = points[rows].max(0) - points[rows].min(0)
            if len(rows) <= LEAF_ROWS or not spread.any():
                leaves.append(rows)
                continue
            axis, half = int(np.argmax(spread)), len(rows) // 2
            order = np.argpartition(points[rows, axis], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.rows = np.concatenate(leaves)
        self.sizes = np.array([len(r) for r in leaves])
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.low = np.array([points[r].min(0) for r in leaves])
        self.high = np.array([points[r].max(0) for r in leaves])

    def outward(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(least squared distance, rows) of the leaves, nearest first, in growing steps."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        distance = (gap * gap).sum(1)
        order, at, step = np.argsort(distance, kind="stable"), 0, 4
        while at < len(order):
            some = order[at : at + step]
            row, within = spread(self.sizes[some])
            yield float(distance[some[0]]), self.rows[self.begin[some][row] + within]
            at, step = at + step, step * 2


def search(tree: Tree, ids, vectors, norms, query_id, query, point, best, k: int, ratio: float) -> list[tuple[float, int]]:
    """Improves ``best`` (a heap of (score, -vec_id)) with the tree's rows until the test holds."""
    norm = math.sqrt(float((query * query).sum()))
    for near, rows in tree.outward(point):
        if len(best) == k and near > ratio * max(2 - 2 * best[0][0], 0):
            break
        if len(best) == k:
            gap = tree.points[rows] - point
            rows = rows[(gap * gap).sum(1) <= ratio * max(2 - 2 * best[0][0], 0) + 1e-12]
        rows = rows[ids[rows] != query_id]
        scores = np.einsum("ij,j->i", vectors[rows], query) / (norms[rows] * norm)
        least = best[0][0] if len(best) == k else (np.partition(scores, -k)[-k] if len(scores) > k else -2.0)
        rows, scores = rows[scores >= least], scores[scores >= least]
        first = np.lexsort((ids[rows], -scores))[:k]  # no others can be among the k nearest
        for score, vec_id in zip(scores[first].tolist(), ids[rows[first]].tolist()):
            entry = (score, -vec_id)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return best


def _search_cell(index: pa.Table, queries: pa.Table, width: int, dims: int, k: int, ratio: float) -> pa.Table:
    out_q, out_v, out_s = [], [], []
    if index.num_rows and queries.num_rows:
        column = lambda t, c: t.column(c).combine_chunks()
        ids = column(index, "vec_id").to_numpy()
        vectors = _matrix(column(index, "embedding"), width)
        norms = np.sqrt((vectors * vectors).sum(1))
        tree = Tree(_matrix(column(index, "point"), dims))
        asked, places = _matrix(column(queries, "embedding"), width), _matrix(column(queries, "point"), dims)
        known = column(queries, "best").to_pylist()
        for i, query_id in enumerate(column(queries, "vec_id").to_pylist()):
            before = [(b["score"], -b["vec_id"]) for b in known[i] or []]
            best = list(before)
            heapq.heapify(best)
            for entry in search(tree, ids, vectors, norms, query_id, asked[i], places[i], best, k, ratio):
                if entry not in before:
                    out_q.append(query_id)
                    out_v.append(-entry[1])
                    out_s.append(entry[0])
    return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})


# ------------------------------------------------------------------ the operator
def valid_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding as doubles) of the vectors that take part, and their width."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    widths = rows.groupBy(F.size("embedding").alias("w")).agg(F.count("*").alias("n"))
    most = widths.agg(F.max_by("w", F.struct("n", "w"))).first()[0]
    return (rows.where(F.size("embedding") == most) if most else rows.limit(0)), most or 1


def _with_points(rows: DataFrame, width: int, dims: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = _project(_matrix(b.column("embedding"), width), dims)
            points = pa.ListArray.from_arrays(pa.array(np.arange(0, points.size + 1, dims), pa.int32()), pa.array(points.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), points], ["vec_id", "embedding", "point"])

    return rows.mapInArrow(add, "vec_id long, embedding array<double>, point array<double>")


def _with_cell(rows: DataFrame, splits: list[tuple[int, float]], dims: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("cell", pa.array(cell_of(_matrix(b.column("point"), dims), splits)))

    return rows.mapInArrow(add, "vec_id long, embedding array<double>, point array<double>, cell long")


def _other_cells(queries: DataFrame, boxes: list[tuple[int, list, list]], dims: int, k: int, ratio: float) -> DataFrame:
    """A row for each cell, other than its own, that a query cannot leave out."""
    cells = np.array([b[0] for b in boxes])
    low, high = np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, home = _matrix(b.column("point"), dims), b.column("cell").to_numpy()
            row, to = [], []
            for i, best in enumerate(b.column("best").to_pylist()):
                gap = np.maximum(np.maximum(low - points[i], points[i] - high), 0)
                far = ratio * max(2 - 2 * min(x["score"] for x in best), 0) if best and len(best) == k else math.inf
                go = np.flatnonzero(((gap * gap).sum(1) <= far) & (cells != home[i]))
                row += [i] * len(go)
                to += cells[go].tolist()
            out = b.take(pa.array(row, pa.int64()))
            yield out.set_column(out.schema.get_field_index("cell"), "cell", pa.array(to, pa.int64()))

    return queries.mapInArrow(add, queries.schema)


def nearest(vectors: DataFrame, is_query, k: int = 5, dims: int = DIMS, stop: float = STOP, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each valid row with ``is_query``."""
    valid, width = valid_vectors(vectors)
    rows = stage(_with_points(valid.dropDuplicates(["vec_id"]), width, dims), "points")
    order = Window.partitionBy("embedding").orderBy("vec_id")
    indexed = rows.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")
    n = rows.count()
    n_cells = 1
    while n_cells * cell_rows < n and n_cells < MAX_CELLS:
        n_cells *= 2
    step = max(1, -(-2 * n // SAMPLE))
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(step)) == 0).select("point").limit(SAMPLE) if n_cells > 1 else rows.limit(0).select("point")
    splits = fit_cells(np.array([r.point for r in sample.collect()]).reshape(-1, dims), n_cells)
    index = stage(_with_cell(indexed, splits, dims), "index")
    queries = stage(_with_cell(rows.where(is_query), splits, dims), "queries")
    limits = [f(F.col("point")[d]) for f in (F.min, F.max) for d in range(dims)]
    boxes = [(r[0], list(r[1 : dims + 1]), list(r[dims + 1 :])) for r in index.groupBy("cell").agg(*limits).collect()]
    ratio = chi_square_quantile(stop, dims)
    n_queries = queries.count()

    def searched(asked: DataFrame, per_cell: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-per_cell // QUERY_BLOCK)))).cast("long")
        asked = stage(asked.withColumn("block", block), "asked")
        wanted = asked.select("cell", F.col("block").alias("to")).distinct()
        offered = index.join(wanted, "cell").select("vec_id", "embedding", "point", F.col("cell").alias("cell"), F.col("to").alias("block"))
        offered = stage(offered, "offered").groupBy("cell", "block")
        run = lambda a, b: _search_cell(a, b, width, dims, k, ratio)
        return offered.cogroup(asked.groupBy("cell", "block")).applyInArrow(run, "query_id long, vec_id long, score double")

    none = F.array().cast("array<struct<vec_id:bigint,score:double>>")
    first = stage(searched(queries.withColumn("best", none), n_queries // n_cells), "first")
    best = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.collect_list(F.struct(F.col("vec_id"), "score")).alias("best"))
    known = queries.join(best, "vec_id", "left").withColumn("best", F.coalesce("best", none))
    found = first.unionByName(searched(_other_cells(known, boxes, dims, k, ratio), n_queries)) if len(boxes) > 1 else first
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
