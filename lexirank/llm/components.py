"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialize

#: Edges of one task where a table's tasks are dealt by its count; edges that a task holds at a time.
TASK_EDGES, HELD_EDGES = 250_000, 2_000_000


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that aren't the least of their component, and the least node of each one's."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars around the least node of each component that they make: as few as connect the same."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def stars() -> pa.RecordBatch:
        found = least_reached(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    for batch in batches:
        a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        held.append((a, b))
        size += len(a)
        if size >= HELD_EDGES:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def local_forests(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, that connect what those given do, as few as each task can tell: no shuffle."""
    return edges.select("a", "b").filter("a <> b").mapInArrow(_forest, "a long, b long")


def _stars(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One large-star and one small-star step over (a, b); and the table of least neighbours that it reads.

    That is a written table: a join with it is between two plain shuffles, so a node with very many edges is split by
    AQE's rule for skewed joins, the other side having one row for it. After it a node has few neighbours under it.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    large = both.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    under = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(under, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(under.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), least


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b), root being the least node of its component.

    Each task first reduces its edges to stars, which needs no shuffle. Where these are more than one task's share,
    large-star and small-star steps alternate, each followed by that reduction, until nothing changes or what is left
    is one task's share. Each round is a written table, in which every component is nearer to a star, so rounds grow with
    the logarithm of the longest path.
    """
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
    now = materialize(local_forests(edges), "edges")
    before = mark(now)
    while before[0] > TASK_EDGES:
        next_, least = _stars(now)
        new = materialize(local_forests(next_), "edges")
        discard(now, least)
        after, now = mark(new), new
        if after == before:
            break
        before = after
    else:
        new = materialize(local_forests(now.coalesce(1)), "edges")
        discard(now)
        now = new
    out = materialize(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "components")
    discard(now)
    return out
