"""Approximate nearest neighbours by largest inner product: randomly rotated one-bit codes in inverted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import discard, materialize

#: Vectors of one dimension that centres are fitted to, at most about, and their bytes; lists of a dimension, at most;
#: dimensions that get centres, the most frequent ones: all vectors of another one are one list.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_LISTS, FITTED_DIMENSIONS = 50_000, 32 << 20, 2048, 8
#: Rows, and queries, that one task holds against each other, at most, and their bytes; blocks of a dimension's rows, about, before they are that large.
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_BYTES, LEAST_BLOCKS = 8192, 8192, 64 << 20, 32
#: Standard errors that the bound of an estimate spans.
EPSILON = 3.0
#: Lists from whose exact scores a query's threshold is taken.
FIRST_LISTS = 3
#: Of a query's k neighbours, the part that is expected at most to be in the lists that it doesn't go to.
LOST = 0.02


@dataclass
class Index:
    """By dimension: centres of the lists, and the covariance of what is left of a vector when its centre is taken away.

    Of a vector in list c: one sign bit for each component of its residual, turned by a random rotation.
    """

    seed: int = 11
    centres: dict[int, np.ndarray] = field(default_factory=dict)
    spread: dict[int, np.ndarray] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_turned"}

    def fit(self, sample: np.ndarray, lists: int) -> Index:
        """Lloyd's rounds from a seeded start over a sample of one dimension."""
        x = sample.astype(np.float64)
        rng = np.random.default_rng(self.seed)
        centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(8):
            own = np.argmin((centres**2).sum(1)[None, :] - 2 * x @ centres.T, axis=1)
            size = np.bincount(own, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        rest = x - centres[np.argmin((centres**2).sum(1)[None, :] - 2 * x @ centres.T, axis=1)]
        self.centres[x.shape[1]], self.spread[x.shape[1]] = centres, rest.T @ rest / len(x)
        return self

    def of(self, d: int) -> np.ndarray:
        return self.centres[d] if d in self.centres else np.zeros((1, d))

    def rotation(self, d: int) -> np.ndarray:
        """Drawn at random by seed and dimension, which is filled up to whole words."""
        if not hasattr(self, "_turned"):
            self._turned = {}
        if d not in self._turned:
            wide = -(-d // 64) * 64
            self._turned[d] = np.linalg.qr(np.random.default_rng([self.seed, d]).standard_normal((wide, wide)))[0][:d]
        return self._turned[d]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, packed bits, length of the residual, and the correction: the inner product of the residual's direction and its code's."""
        centres = self.of(x.shape[1])
        own = np.argmin((centres**2).sum(1)[None, :] - 2 * x @ centres.T, axis=1)
        rest = (x - centres[own]) @ self.rotation(x.shape[1])
        length = np.sqrt((rest**2).sum(1))
        correction = np.abs(rest).sum(1) / np.sqrt(rest.shape[1]) / np.maximum(length, 1e-300)
        return own, np.packbits(rest > 0, axis=1, bitorder="little"), length, np.where(length > 0, correction, 1.0)

    def estimate(self, queries: np.ndarray, lists: int, bits: np.ndarray, length: np.ndarray, correction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of queries with the coded vectors of a list, and bounds of the error: codes as +1 and -1, one matrix product."""
        d = queries.shape[1]
        turned = (queries @ self.rotation(d)).astype(np.float32)
        wide = turned.shape[1]
        signs = np.unpackbits(bits, axis=1, bitorder="little").astype(np.float32) * 2 - 1
        on_code = (turned @ signs.T).astype(np.float64) / np.sqrt(wide)
        estimate = (queries @ self.of(d)[lists])[:, None] + on_code * (length / correction)
        spread = np.sqrt(np.maximum(1 - correction**2, 0) / max(wide - 1, 1)) / correction
        size = np.sqrt((queries**2).sum(1, keepdims=True))
        return estimate, size * (length * (EPSILON * spread + 1e-5))[None, :]

    def lists_for(self, queries: np.ndarray, floor: np.ndarray, counts: np.ndarray, lost: float) -> np.ndarray:
        """Which lists each query goes to: those left out are expected to hold no more than `lost` vectors over its floor.

        A list's share of vectors over the floor is taken as at most that of a normal variable with the mean of
        the query on the centre and its variance on the residuals; a query without a floor goes to all lists.
        """
        d = queries.shape[1]
        if d not in self.centres:
            return np.repeat(counts[None, :] > 0, len(queries), axis=0)
        deviation = np.sqrt(np.maximum(((queries @ self.spread[d]) * queries).sum(1), 1e-300))
        z = np.maximum((floor[:, None] - queries @ self.of(d).T) / deviation[:, None], 0.0)
        hits = counts * np.where(z > 0, 0.5 * np.exp(-0.5 * z * z), 1.0)
        order = np.argsort(hits, axis=1)
        few = np.cumsum(np.take_along_axis(hits, order, axis=1), axis=1) <= lost
        out = np.ones(hits.shape, dtype=bool)
        np.put_along_axis(out, order, ~few, axis=1)
        return out & (counts > 0)


@dataclass
class Lists:
    """By dimension: how many vectors each list has, and its bundle: lists in a row that tasks hold together."""

    counts: dict[int, np.ndarray]
    bundles: dict[int, np.ndarray]
    blocks: list[int]  # of each bundle


def _by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of each dimension of a column of lists without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    at = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        where = np.flatnonzero(size == d)
        yield where, flat[at[where][:, None] + np.arange(d)].astype(np.float64)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


CODED = "row long, v array<double>, ids array<long>, d int, list int, bits binary, length double, correction double"


def _encoder(index):
    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, x in _by_dimension(batch.column(1)):
                own, bits, length, correction = index.value.encode(x)
                at = pa.array(where)
                arrays = [
                    *(c.take(at) for c in batch.columns), pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(own.astype(np.int32)),
                    pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(correction),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in CODED.split(", ")])

    return encode_batches


PROBES = "bundle int, q long, query_id long, v array<double>, floor double, lists array<int>"


def _prober(index, lists, first: bool, lost: float):
    """Of queries (q, query_id, v, floor) a row for each bundle that they go to, with the lists in it: the nearest FIRST_LISTS, or others."""

    def probe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, ls = index.value, lists.value
        for batch in batches:
            for where, x in _by_dimension(batch.column(2)):
                counts, bundles = ls.counts.get(x.shape[1]), ls.bundles.get(x.shape[1])
                if counts is None:
                    continue
                near = np.where(counts > 0, x @ ix.of(x.shape[1]).T, -np.inf)
                nearest_ = np.zeros(near.shape, dtype=bool)
                np.put_along_axis(nearest_, np.argsort(-near, axis=1, kind="stable")[:, :FIRST_LISTS], True, axis=1)
                nearest_ &= counts > 0
                goes = nearest_ if first else ix.lists_for(x, batch.column(3).to_numpy(zero_copy_only=False)[where], counts, lost) & ~nearest_
                row, which = np.nonzero(goes)  # by query, then by list, so bundles come in a row
                opens = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (bundles[which[1:]] != bundles[which[:-1]])])) if len(row) else row
                at = pa.array(where[row[opens]])
                ends = pa.array(np.append(opens, len(row)).astype(np.int32))
                arrays = [pa.array(bundles[which[opens]].astype(np.int32)), *(c.take(at) for c in batch.columns), pa.ListArray.from_arrays(ends, pa.array(which.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in PROBES.split(", ")])

    return probe_batches


FOUND = "q long, query_id long, score double, first long, ids array<long>"
_NONE = np.iinfo(np.int64).max


def _searcher(index, k: int):
    names = {"q": pa.int64(), "query_id": pa.int64(), "score": pa.float64(), "first": pa.int64(), "ids": pa.list_(pa.int64())}

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], t) for n, t in names.items()})
        ix = index.value
        rows = rows.sort_by("list")
        x, asked = _matrix(rows["v"]), _matrix(queries["v"])
        bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), dtype=np.uint8).reshape(len(x), -1)
        length, correction, own = rows["length"].to_numpy(), rows["correction"].to_numpy(), rows["list"].to_numpy()
        ids = rows["ids"].combine_chunks()
        flat, bounds = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
        least_id = flat[bounds[:-1]]
        second = np.where(np.diff(bounds) > 1, flat[np.minimum(bounds[:-1] + 1, len(flat) - 1)], _NONE)
        query_id, floor = queries["query_id"].to_numpy(), queries["floor"].to_numpy()
        least = floor.copy()
        wanted = queries["lists"].combine_chunks()
        wanted_list, wanted_by = wanted.flatten().to_numpy(), np.repeat(np.arange(len(asked)), wanted.value_lengths().to_numpy())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        edges = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
        for a, b in zip(edges[:-1], edges[1:]):
            by = wanted_by[wanted_list == own[a]]
            for start in range(0, len(by), 256):
                q = by[start : start + 256]
                estimate, bound = ix.estimate(asked[q], int(own[a]), bits[a:b], length[a:b], correction[a:b])
                alone = (query_id[q][:, None] == least_id[None, a:b]) & (second[None, a:b] == _NONE)
                upper, lower = np.where(alone, -np.inf, estimate + bound), np.where(alone, -np.inf, estimate - bound)
                if b - a >= k:
                    least[q] = np.maximum(least[q], np.partition(lower, b - a - k, axis=1)[:, b - a - k])
                i, j = np.nonzero((upper >= least[q][:, None]) & ~alone)
                found.append((q[i], a + j, upper[i, j]))
        who, row, upper = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        keep = upper >= least[who]
        who, row = who[keep], row[keep]
        score = np.concatenate([np.zeros(0), *((x[row[s : s + 65536]] * asked[who[s : s + 65536]]).sum(1) for s in range(0, len(row), 65536))])
        keep = score >= floor[who]
        who, row, score = who[keep], row[keep], score[keep]
        first = np.where(least_id[row] == query_id[who], second[row], least_id[row])
        order = np.lexsort((first, -score, who))
        who, row, score, first = who[order], row[order], score[order], first[order]
        opens = np.searchsorted(who, who)
        keep = np.arange(len(who)) - opens < k
        who, row, score, first = who[keep], row[keep], score[keep], first[keep]
        at = pa.array(row)
        arrays = [queries["q"].combine_chunks().take(pa.array(who)), pa.array(query_id[who]), pa.array(score), pa.array(first), ids.take(at)]
        return pa.Table.from_arrays(arrays, schema=pa.schema(names))

    return search


def usable(vector):
    """Neither null nor zero, and without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def fitted(distinct: DataFrame, counts: dict[int, int], seed: int) -> Index:
    """An index of the most frequent dimensions, from samples by a hash of the row's id."""
    index, shares = Index(seed), {}
    for d in sorted(counts, key=lambda d: (-counts[d], d))[:FITTED_DIMENSIONS]:
        if _lists(counts[d]) > 1:
            shares[d] = max(1, int(min(1.0, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * d)) / counts[d]) * (1 << 30)))
    if shares:
        share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.size("v")]
        sample = distinct.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share).select("row", "v").toArrow().sort_by("row")
        for where, x in _by_dimension(sample["v"].combine_chunks()) if sample.num_rows else ():
            index.fit(x, min(_lists(counts[x.shape[1]]), max(1, len(x) // 8)))
    return index


def _lists(rows: int) -> int:
    return max(1, min(MOST_LISTS, round(math.sqrt(rows) / 2)))


def bundled(coded: DataFrame, index: Index) -> Lists:
    """Lists in a row, put together until they fill a block; a list of more rows than that has several blocks."""
    out = Lists({}, {}, [])
    for d, number, count in sorted(tuple(r) for r in coded.groupBy("d", "list").count().collect()):
        out.counts.setdefault(d, np.zeros(len(index.of(d)), dtype=np.int64))[number] = count
    for d, counts in out.counts.items():
        block, bundle, held = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * d), int(counts.sum()) // LEAST_BLOCKS)), [], None
        for count in counts.tolist():
            if held is None or held + count > block:
                out.blocks.append(0)
                held = 0
            held += count
            bundle.append(len(out.blocks) - 1)
            out.blocks[-1] = max(1, -(-held // block))
        out.bundles[d] = np.array(bundle)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", lost: float = LOST, seed: int = 11) -> DataFrame:
    """For each query its k nearest of the vectors (query_id, rank, vec_id, score), a vector of the query's own id apart.

    Nearness is the inner product in double precision of the vectors as they are; ties go to the smaller id.
    Rows with a null id, or a vector that is null, zero or has null or non-finite components, take no part; rows that
    repeat id and vector count once. An id with several vectors has as score the best of them, as a query and as a
    candidate. A query's candidates are the vectors of its own dimension. With fewer than k candidates all that are
    found are given; without rows or queries the result is empty.

    The index (list centres of samples of about SAMPLE_ROWS, by a hash of the id) takes every row. Equal vectors share
    one code with their k + 1 smallest ids: no more of them can be among the k nearest. A query's exact scores in its
    nearest lists give a floor. It then goes to the lists that may hold vectors over that: those left out hold less than
    `lost` of its k by expectation. There codes give estimates, and only vectors whose estimate and error bound reach
    the floor are scored. Lists and queries meet in blocks, so no list falls to one task. Counts of dimensions
    and lists come to the driver: as many as the longest vector has components, and MOST_LISTS for each fitted one.
    """
    spark = vectors.sparkSession
    v = lambda df, name: df.select(F.col(id_col).cast("long").alias(name), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col(name).isNotNull() & usable(F.col("v")))
    rows, asked = v(vectors, "id"), v(queries, "query_id")
    by_id = Window.partitionBy("v").orderBy("id")
    few = rows.dropDuplicates(["id", "v"]).withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    distinct = materialize(few.groupBy("v").agg(F.min("id").alias("row"), F.array_sort(F.collect_list("id")).alias("ids")).select("row", "v", "ids"), "vectors")
    asked = materialize(asked.distinct().select(F.monotonically_increasing_id().alias("q"), "query_id", "v"), "queries")
    counts = dict(distinct.groupBy(F.size("v")).count().collect())
    index = fitted(distinct, counts, seed)
    held = spark.sparkContext.broadcast(index)
    coded = materialize(distinct.mapInArrow(_encoder(held), CODED), "codes")
    discard(distinct)
    lists = bundled(coded, index)
    where = spark.sparkContext.broadcast(lists)
    bundle_of = [(d, i, int(b), lists.blocks[b]) for d, bs in lists.bundles.items() for i, b in enumerate(bs.tolist())]
    bundle_of = F.broadcast(spark.createDataFrame(bundle_of, "d int, list int, bundle int, blocks int"))
    dealt = coded.join(bundle_of, ["d", "list"]).withColumn("rb", F.pmod(F.xxhash64("row", "ids"), F.col("blocks")).cast("int"))

    def search(part: DataFrame) -> DataFrame:
        size = F.greatest(F.lit(64), F.least(F.lit(BLOCK_QUERIES), F.lit(BLOCK_BYTES) / (8 * F.max(F.size("v")))))
        busy = F.broadcast(part.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("query_blocks")))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        blocks = bundle_of.select("bundle", "blocks").distinct()
        left = dealt.join(busy, "bundle").withColumn("qb", each("query_blocks")).select("bundle", "rb", "qb", "list", "v", "ids", "bits", "length", "correction")
        right = part.join(busy, "bundle").join(F.broadcast(blocks), "bundle").withColumn("qb", F.pmod(F.xxhash64("q"), F.col("query_blocks")).cast("int")).withColumn("rb", each("blocks"))
        right = right.select("bundle", "rb", "qb", "q", "query_id", "v", "floor", "lists")
        return left.groupBy("bundle", "rb", "qb").cogroup(right.groupBy("bundle", "rb", "qb")).applyInArrow(_searcher(held, k), FOUND)

    best = lambda df: df.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))).filter(F.col("n") <= k).drop("n")
    no_floor = asked.select("q", "query_id", "v", F.lit(float("-inf")).alias("floor"))
    near = materialize(no_floor.mapInArrow(_prober(held, where, True, lost * k), PROBES), "near")
    first = materialize(best(search(near)), "first")
    floors = first.groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    sure = asked.join(floors, "q", "left").select("q", "query_id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    more = materialize(sure.mapInArrow(_prober(held, where, False, lost * k), PROBES), "probes")
    each = best(first.unionByName(search(more))).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
