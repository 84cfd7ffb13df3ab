"""Union-find grouping of links, without bringing links or components to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import map_batches

LINK = "a long, b long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task: each node with the smallest of its group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(part, pa.int64()), "b": pa.array(map(root, part), pa.int64())}
        )


def _attach_to_smallest(links: DataFrame) -> DataFrame:
    """Large-star: every larger neighbour of a node moves to the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    smallest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    moved = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.distinct()


def _gather_smaller(links: DataFrame) -> DataFrame:
    """Small-star: a node and its smaller neighbours move to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(smallest).filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (a, b): each linked node but the smallest, with the smallest of its component.

    Tasks first contract their own links by union-find; large-star and
    small-star steps then join the trees of all tasks until each is a star.
    """
    trees = stored(map_batches(links.select("a", "b"), _contract, LINK).distinct(), "trees")
    while not _are_stars(trees):
        trees = stored(_gather_smaller(_attach_to_smallest(trees)), "trees")
    return trees


def _are_stars(trees: DataFrame) -> bool:
    """Every node hangs on one root, and no root hangs on another node."""
    twice = trees.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("a")
    roots = trees.select(F.col("b").alias("a")).distinct()
    return twice.union(trees.select("a").join(roots, "a", "left_semi")).isEmpty()
