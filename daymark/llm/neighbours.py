"""Nearest neighbours by inner product over low-dimensional stable projections.

A vector x becomes (x / M, sqrt(1 - |x|^2 / M^2)), where M is the largest norm, and a
query q becomes (q / |q|, 0): the nearest point is then the one with the
largest inner product. Points are projected on a few Gaussian directions
and indexed by a kd-tree. The squared projected distance of a point at
distance d is d^2 times a chi-square variable. A query walks the leaves in the
order of their projected distance and verifies their points on the original vectors.
It stops at a leaf so far away that a point as near as its k-th would have been met
earlier with probability ``confidence``.

Vectors and queries are dealt into blocks of bounded size by a hash of id and vector; each pair
of a block of vectors and a block of queries is one group with its own tree,
and the best of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import

SEED = 20
FOUND = "query_id long, vec_id long, score double"
VISIT = 8  # leaves that are verified between two stopping tests
QUERIES_AT_ONCE = 512


def chi_square(x: np.ndarray, even: int) -> np.ndarray:
    """Probability that a chi-square variable with an even number of degrees is at most x."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, even // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def kd_leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of each leaf: halves along the widest side, down to ``size`` points."""
    leaves, open_nodes = [], [np.arange(len(points))]
    while open_nodes:
        rows = open_nodes.pop()
        if len(rows) <= size:
            leaves.append(rows)
            continue
        inside = points[rows]
        side = int(np.argmax(inside.max(axis=0) - inside.min(axis=0)))
        order = np.argpartition(inside[:, side], len(rows) // 2)
        open_nodes += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return leaves


class ProjectedTree:
    """A kd-tree over the projections of some distinct vectors."""

    def __init__(self, vectors: np.ndarray, longest: float, projections: int, leaf: int):
        self.vectors, self.longest, self.projections = vectors, longest, projections
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, projections))
        scaled = vectors / longest
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        points = np.column_stack([scaled, rest]) @ self.directions
        self.leaves = kd_leaves(points, leaf)
        self.low = np.array([points[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in self.leaves])
        self.leaf_size = max(len(rows) for rows in self.leaves)

    def best(self, queries: np.ndarray, k: int, confidence: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the ``k`` best of each query (-1: fewer were there) and the number of verified points."""
        norms = np.sqrt((queries**2).sum(axis=1))
        points = (queries / norms[:, None]) @ self.directions[:-1]
        far = np.zeros((len(queries), len(self.leaves)))
        for j in range(self.projections):
            side = points[:, j, None]
            far += np.maximum(0, np.maximum(self.low[:, j] - side, side - self.high[:, j])) ** 2
        order = np.argsort(far, axis=1)
        far = np.take_along_axis(far, order, axis=1)
        rows = np.full((len(queries), k), -1)
        scores = np.full((len(queries), k), -np.inf)
        verified = np.zeros(len(queries), dtype=np.int64)
        active = np.arange(len(queries))
        for low in range(0, len(self.leaves), VISIT):
            visit = order[active, low : low + VISIT]
            new_rows = np.full((len(active), visit.shape[1] * self.leaf_size), -1)
            new_scores = np.full(new_rows.shape, -np.inf)
            of_leaf = np.argsort(visit, axis=None, kind="stable")
            which, begins = np.unique(visit.reshape(-1)[of_leaf], return_index=True)
            for number, group in zip(which, np.split(of_leaf, begins[1:]), strict=True):
                members = self.leaves[number]
                at, slot = np.divmod(group, visit.shape[1])
                places = (slot * self.leaf_size)[:, None] + np.arange(len(members))
                new_scores[at[:, None], places] = queries[active[at]] @ self.vectors[members].T
                new_rows[at[:, None], places] = members
            verified[active] += (new_rows >= 0).sum(axis=1)
            all_scores = np.concatenate([scores[active], new_scores], axis=1)
            all_rows = np.concatenate([rows[active], new_rows], axis=1)
            top = np.argpartition(-all_scores, k - 1, axis=1)[:, :k]
            scores[active] = np.take_along_axis(all_scores, top, axis=1)
            rows[active] = np.take_along_axis(all_rows, top, axis=1)
            if low + VISIT >= len(self.leaves):
                break
            worst = scores[active].min(axis=1)
            distance = np.maximum(2 - 2 * worst / (self.longest * norms[active]), 1e-300)
            stop = np.isfinite(worst)
            stop[stop] = chi_square(far[active, low + VISIT][stop] / distance[stop], self.projections) >= confidence
            active = active[~stop]
            if not len(active):
                break
        return rows, verified


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component to the last, so that equal rows score equal."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def _search(k: int, longest: float, projections: int, leaf: int, confidence: float) -> Callable:
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            ids, matrix = vectors["vec_id"].to_numpy(), _matrix(vectors["vector"]) + 0.0
            order = np.argsort(ids, kind="stable")
            ids, matrix = ids[order], matrix[order]
            _, first, copy_of = np.unique(
                matrix.view(np.dtype((np.void, matrix.shape[1] * 8))).reshape(-1), return_index=True, return_inverse=True
            )
            distinct = matrix[first]
            by_copy = np.argsort(copy_of, kind="stable")
            bounds = np.searchsorted(copy_of[by_copy], np.arange(len(first) + 1))
            ids_of = [np.unique(ids[by_copy[a:b]])[: k + 1] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            copies = np.array([len(x) for x in ids_of])
            tree = ProjectedTree(distinct, longest, projections, leaf)
            query_ids, query_rows = np.unique(queries["vec_id"].to_numpy(), return_index=True)
            query_matrix = _matrix(queries["vector"])[query_rows]
            # One more than k, as a query may meet itself, and a few for rounding in the matrix product.
            wanted = min(k + 1 + 8, len(distinct))
            for low in range(0, len(query_ids), QUERIES_AT_ONCE):
                part, part_ids = query_matrix[low : low + QUERIES_AT_ONCE], query_ids[low : low + QUERIES_AT_ONCE]
                rows, _ = tree.best(part, wanted, confidence)
                at, slot = np.nonzero(rows >= 0)
                found = rows[at, slot]
                score = inner_products(part[at], distinct[found])
                n = copies[found]
                query = np.repeat(part_ids[at], n)
                vec = np.concatenate([ids_of[i] for i in found]) if len(found) else ids[:0]
                score = np.repeat(score, n)
                other = vec != query
                query, vec, score = query[other], vec[other], score[other]
                best = np.lexsort((vec, -score, query))
                query, vec, score = query[best], vec[best], score[best]
                heads = np.searchsorted(query, query, side="left")
                top = np.arange(len(query)) - heads < k
                out.append((query[top], vec[top], score[top]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"]
        )

    return run


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = vectors.filter(finite & F.exists(vector, lambda x: x != 0) & F.col(id_column).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    # Combined before the shuffle, so that many equal rows don't meet in one block.
    return rows.dropDuplicates(["vec_id", "vector"])


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    projections: int = 8,
    confidence: float = 0.98,
    block: int = 8192,
    query_block: int = 4096,
    leaf: int = 32,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found for each query.

    A row never finds its own id. Ties go to the smaller id. Vectors that are null,
    zero or hold null, NaN or infinite components take no part, nor do rows without
    an id; vectors of another length than the query's are not compared. Rows with the same
    id and vector count once. With fewer candidates than ``k``, all are returned; without
    any, a query has no rows. Other columns are not read.
    """
    vectors, queries = (stored(usable(x, id_column, vector_column), "vectors") for x in (vectors, queries))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, longest = vectors.agg(F.count(F.lit(1)), F.sqrt(F.max(squares))).first()
    n_queries = queries.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return rows.select(
            "vec_id",
            "vector",
            F.size("vector").alias("_size"),
            F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other),
        )

    keys = ("_size", "_block", "_query_block")
    let_workers_import(vectors.sparkSession)
    found = (
        dealt(vectors, "_block", blocks, "_query_block", query_blocks)
        .groupBy(*keys)
        .cogroup(dealt(queries, "_query_block", query_blocks, "_block", blocks).groupBy(*keys))
        .applyInArrow(_search(k, float(longest or 1.0), projections, leaf, confidence), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
