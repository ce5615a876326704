"""Compression of vectors into four bytes: a codebook for each quarter, fitted by filtering Lloyd on kd-trees."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kdtree import Tree, assign, build, squared
from .storage import importable, materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components of a block of vectors, over which a tree for each part is built.
BLOCK_VALUES = 1 << 19
#: Components beyond this (x over 262,144) have squared distances that 64 bits don't hold.
LARGEST = 1 << 28

BLOCKS = "ids array<long>, labels array<string>, trees array<binary>"
SUMS = "part int, entry int, n long, sums array<long>"
CODES = "vec_id long, label string, code string, error long"


def _rows_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Vectors that take part, as whole numbers: no null, and no null or non-finite component."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.col(label_col).cast("string") if label_col in vectors.columns else F.lit(None).cast("string")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), label.alias("label")).filter(F.col("x").isNotNull() & finite)
    large = F.exists("x", lambda v: F.abs(v) > LARGEST / SCALE)
    checked = F.when(large, F.raise_error(F.lit(f"a component is beyond {LARGEST / SCALE:,.0f}: its squared distances don't fit 64 bits")).cast("array<double>")).otherwise(F.col("x"))
    return rows.select("vec_id", F.transform(checked, lambda v: F.floor(v * SCALE).cast("long")).alias("v"), "label")


def _dump(tree: Tree) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{k: getattr(tree, k) for k in Tree.ARRAYS})
    return out.getvalue()


def _load(tree: pa.Scalar) -> Tree:
    with np.load(io.BytesIO(tree.as_py())) as found:
        return Tree(**found)


def _plant(dimension: int):
    """Blocks of the rows of a task, with a tree for each part."""
    most, width = max(64, BLOCK_VALUES // dimension), dimension // PARTS

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                block = batch.slice(at, most)
                points = block.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
                trees = [_dump(build(points[:, p * width : (p + 1) * width])) for p in range(PARTS)]
                columns = [[block.column(0).to_pylist()], [block.column(1).to_pylist()], [trees]]
                kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["ids", "labels", "trees"])

    return plant


def _step(held: Broadcast):
    """Sums and counts of the entries that a task's vectors go to: one row for each part and entry."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = held.value
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in batches:
            for trees in batch.column(0):
                for p, tree in enumerate(trees):
                    found = assign(_load(tree), codebooks[p])
                    sums[p] += found.sums
                    counts[p] += found.counts
        rows = [(p, int(e), int(counts[p][e]), sums[p][e].tolist()) for p in range(PARTS) for e in np.flatnonzero(counts[p])]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "entry", "n", "sums"])

    return step


def _code(held: Broadcast):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = held.value
        for batch in batches:
            for ids, labels, trees in zip(batch.column(0), batch.column(1), batch.column(2)):
                error = np.zeros(len(ids), np.int64)
                codes = np.zeros((len(error), PARTS), np.uint8)
                for p, tree in enumerate(map(_load, trees)):
                    nearest = assign(tree, codebooks[p]).nearest
                    codes[tree.order, p] = nearest
                    error[tree.order] += squared(tree.points, codebooks[p][nearest])
                text = codes.tobytes().hex()
                made = pa.array([text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)])
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, made, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return code


def codebooks_text(codebooks: list[np.ndarray]) -> str:
    """All entries' components by part, entry and position."""
    return ",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist())


def fit_and_code(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """A row of CODES for each vector that takes part, and the codebooks.

    A component x becomes floor(1024 * x); a vector is cut into four equal parts. The codebook of a part starts as that
    part of the 256 vectors with the smallest ids (null ids last, rows of one id by their components), fewer if there
    are fewer; four times every entry becomes the floored mean of the parts it is nearest to, ties to the lower index.
    Vectors that are null, or hold null or non-finite components, are left out. The dimension is that of the vector
    with the smallest id; vectors of another one, and all where it is no multiple of four, come with a null code and
    error. A component beyond 262,144 is an error. Repeated rows count as often as they are there; other columns
    aren't read; an empty table gives an empty result and no codebooks.

    Trees are built once and written, in blocks of bounded size; each round reads them and returns sums for at most
    1,024 entries from each task, added up by Spark before the driver sees 1,024 rows. Sums are of 64 bits.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = materialize(_rows_of(vectors, id_col, vector_col, label_col), "vectors")
    by_id = [F.col("vec_id").asc_nulls_last(), "v"]
    smallest = rows.orderBy(*by_id).select(F.size("v").alias("n")).first()
    dimension = smallest.n if smallest and smallest.n and smallest.n % PARTS == 0 else 0
    fits = F.size("v") == dimension if dimension else F.lit(False)
    odd = rows.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not dimension:
        return odd, []
    start = np.array([r.v for r in rows.filter(fits).orderBy(*by_id).limit(ENTRIES).select("v").collect()], np.int64)
    codebooks = [np.ascontiguousarray(c) for c in np.split(start, PARTS, axis=1)]
    blocks = materialize(rows.filter(fits).select("vec_id", "label", "v").mapInArrow(_plant(dimension), BLOCKS), "vector-trees")
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast(codebooks)
        found = blocks.select("trees").mapInArrow(_step(held), SUMS).select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
        found = found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        found = found.groupBy("part", "entry").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "x"))).alias("sums"))
        codebooks = [c.copy() for c in codebooks]
        for r in found.collect():
            codebooks[r.part][r.entry] = [s.x // r.n for s in r.sums]
    held = spark.sparkContext.broadcast(codebooks)
    return blocks.mapInArrow(_code(held), CODES).unionByName(odd), codebooks


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Rows of CODES with label_error, the sum of error over all rows of a label, null labels together. Sums are a written table, so a label that very many have is split."""
    coded = materialize(coded, "vector-codes")
    sums = materialize(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(sums.hint("merge"), F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def codebooks_sha256(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
