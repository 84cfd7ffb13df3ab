import math

import numpy as np
import pytest

from daymark.llm.neighbours import ProjectedTree, chi_square, kd_leaves, nearest
from daymark.llm.queries import QUERIES
from tests.conftest import SMALL


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, "x", None) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int"
    )


def brute(rows, queries, k):
    usable = [
        (i, [float(np.float32(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)
    ]
    usable = sorted(set((i, tuple(v)) for i, v in usable))
    out = []
    for q, a in usable:
        if q in queries:
            found = sorted(
                (-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(b) == len(a)
            )
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def odd_vectors():
    draw = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((150, 12)) * draw.uniform(0.1, 3, (150, 1)))]
    same = rows[3][1]
    rows += [(200 + i, same) for i in range(40)]  # ties
    rows += [rows[5], rows[5], (300, None), (301, [0.0] * 12), (302, [None] * 12), (303, [float("nan")] * 12)]
    rows += [(304, [float("inf")] * 12), (305, []), (None, same), (306, [1.0, 2.0]), (320, [2.0, 1.0])]
    return rows


@pytest.mark.parametrize("block", [16, 8192])
def test_against_brute_force(spark, block):
    rows = odd_vectors()
    vectors = frame(spark, rows)
    got = nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=7, block=block, query_block=6, confidence=0.9999)
    expected = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 7)
    got = sorted(map(tuple, got.collect()))
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=1e-15)


def test_empty_tables(spark):
    some, none = frame(spark, odd_vectors()), frame(spark, [])
    assert nearest(none, none).collect() == []
    assert nearest(none, some).collect() == [] and nearest(some, none).collect() == []


def test_recall_of_the_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected = {e[:1] + e[2:3] for e in brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)}
    got = {(r.query_id, r.vec_id) for r in QUERIES["op3_projected_neighbours"](spark, SMALL).collect()}
    assert len(got & expected) >= 0.9 * len(expected) and len(got) == len(expected)


def test_the_stopping_test_saves_points_and_keeps_neighbours():
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((40, 32))
    points = np.repeat(centres, 50, axis=0) + 0.05 * draw.standard_normal((2000, 32))
    tree = ProjectedTree(points, np.sqrt((points**2).sum(axis=1)).max(), 8, 16)
    queries = points[::50]
    rows, verified = tree.best(queries, 10, 0.95)
    true = np.argsort(-(queries @ points.T), axis=1)[:, :10]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(rows, true)])
    assert recall >= 0.9 and verified.mean() < 1900


def test_parts():
    assert chi_square(np.array([0.0, 2.0]), 2) == pytest.approx([0, 1 - math.exp(-1)])
    leaves = kd_leaves(np.random.default_rng(0).standard_normal((1000, 3)), 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 16
