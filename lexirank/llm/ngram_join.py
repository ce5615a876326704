"""N-gram Jaccard join: blocks of the document by n-gram incidence matrix, multiplied by their transposes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .sieve import may_be_among
from .storage import discard, materialize
from .textbytes import SPACED, mix, shingles, words

#: Documents, and n-grams, of one block of the matrix; and columns of one product.
BLOCK_DOCS, BLOCK_GRAMS, BLOCK_COLUMNS = 512, 1_000_000, 4096
#: Documents of a cluster that every block of it holds.
PIVOTS = 8

_PART = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=None)
def size_classes(percent: int, upto: int) -> tuple[int, ...]:
    """Least sizes of the classes: sizes whose ratio allows a link fall into one class or two neighbours."""
    bounds = [1]
    while bounds[-1] <= upto:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // percent)))
    bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // percent)))
    return tuple(bounds)


def parts_of_level(percent: int, least: int) -> tuple[int, int]:
    """For pairs whose smaller set is less than `least`: how many n-grams can stand in one set alone, and parts.

    With d such n-grams at most, all but d parts of the n-grams are alike in both sets. Parts are more than d by
    enough to make up for those that stay empty by chance, and by a sixth, so that of a link many parts are alike.
    """
    d = (least - 1) * (100 - percent) // percent
    empty = math.exp(-percent * percent / (100.0 * (100 - percent))) if percent < 100 else 0.0
    return d, d + 2 + d // 6 + math.ceil(1.5 * empty * (d + 1))


def signatures(sets: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sets of n-grams (distinct, of document i: bounds[i]..bounds[i+1]): hashes of their parts, whose each is, and spares.

    A set has parts on two levels; whose: 2 * i + level. spares[whose]: so many parts of a set on one level, and more,
    it has in common with any set that it is linked with on that level, unless they are equal.
    """
    n = np.diff(bounds)
    if not len(n) or not n.max():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(2 * len(n), np.int64)
    classes = np.array(size_classes(percent, 1 << int(n.max()).bit_length()))
    own = np.searchsorted(classes, n, side="right") - 1
    doc = np.repeat(np.arange(len(n)), n)
    spread = (mix(sets ^ _PART) >> np.uint64(32)).astype(np.int64)
    weight = mix(sets * np.uint64(3) + _PART)
    values, whose, spares = [], [], np.zeros((len(n), 2), np.int64)
    for step in (0, 1):
        level = np.maximum(own + step, 0)
        table = np.array([parts_of_level(percent, int(x)) for x in classes[: level.max() + 1]])
        differ, parts = table[level, 0], table[level, 1]
        used = (differ > 0) & (n > 0)
        parts = np.where(used, parts, 0)
        first = np.cumsum(parts) - parts
        at = np.flatnonzero(used[doc])
        d = doc[at]
        cell = first[d] + ((spread[at] * parts[d]) >> 32)
        total = int(parts.sum())
        sums = np.zeros(total, dtype=np.uint64)
        np.add.at(sums, cell, weight[at])
        filled = np.bincount(cell, minlength=total) > 0
        cell_doc = np.repeat(np.arange(len(n)), parts)
        count = np.bincount(cell_doc[filled], minlength=len(n))
        spares[:, step] = np.maximum(count - differ, 1)
        out = np.flatnonzero(filled | (count <= differ)[cell_doc])  # a set with too few filled parts has its empty ones as well
        d = cell_doc[out]
        name = mix((level[d].astype(np.uint64) << np.uint64(40)) + (out - first[d]).astype(np.uint64))
        values.append(mix(sums[out] + name))
        whose.append(2 * d + step)
    return np.concatenate(values), np.concatenate(whose), spares.ravel()


def gram_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """In blocks of texts: how many, their sets of k-word shingles (hashes, sorted, distinct), and bounds."""
    for block in words(texts, SPACED, 1 << 20):
        grams, at = shingles(block.hashes(), block.bounds, k)
        sets = [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield block.docs, np.concatenate(sets) if sets else grams, np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


SKETCH = "key long, doc_id long, n_shingles long, set_id long"
#: Sets that a task remembers to have given the parts of; parts that it holds before it gives them out.
GIVEN_SETS, HELD_PARTS = 100_000, 400_000
#: Parts of one range, about: what a task holds at a time to find those that are alike. A part that more of the sets
#: that a task holds have is a common one.
RANGE_PARTS, COMMON = 1_000_000, 128
#: Bytes of unpacked parts that a task compares at a time: about 20 for each part.
HELD_BYTES = 8 << 20


def _set_ids(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets + _PART), dtype=np.uint64)])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _sketcher(k: int):
    def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for docs, sets, bounds in gram_sets(batch.column(2), k):
                arrays = [batch.column(0).slice(done, docs), batch.column(1).slice(done, docs), pa.array(np.diff(bounds)), _longs(_set_ids(sets, bounds))]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "doc_id", "n_shingles", "set_id"])
                done += docs

    return sketch_batches


def part_bits(sets: int) -> int:
    """Bits of a part's hash that are kept: of sets that have nothing in common, about one in a thousand has a like part by chance."""
    return min(62, 26 + max(sets, 1).bit_length())


def packed_parts(parts: np.ndarray, whose: np.ndarray, ids: np.ndarray, spares: np.ndarray, bits: int, ranges: int) -> pa.RecordBatch:
    """Rows (range, parts): the parts of a range of hashes, of several sets of a task, in order, and their sets.

    whose: of each part; ids and spares (twice the number, and the level): by whose. Of a common part the range learns only
    that it is one; the sets that have it go out under ranges of a second kind, dealt by part and task, so no task
    gets them all.
    """
    parts = parts >> np.uint64(64 - bits)
    order = np.argsort(parts, kind="stable")
    parts, whose = parts[order], whose[order]
    first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
    size = np.diff(np.append(first, len(parts)))
    common = size > COMMON
    inside = np.repeat(common, size)
    of_common, owners = parts[inside], whose[inside]
    lead = np.repeat(ids[whose[first[common]]], size[common])
    mark = first[common]
    whose[mark], inside[mark] = len(ids), False  # the mark of a common part has no set and no spares
    ids, spares = np.append(ids, np.uint64(0)), np.append(spares, np.uint32(0))
    width = -(-(1 << bits) // ranges)
    second = ranges + (mix(of_common ^ mix(lead)) % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((of_common, second))
    which = np.concatenate([(parts[~inside] // np.uint64(width)).astype(np.int64), second[order]])
    parts, whose = np.concatenate([parts[~inside], of_common[order]]), np.concatenate([whose[~inside], owners[order]])
    edges = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]]))
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        there = np.bincount(whose[a:b], minlength=len(ids)) > 0
        number = (np.cumsum(there) - 1).astype(np.uint32)
        steps = np.diff(parts[a:b], prepend=np.uint64(which[a] * width if which[a] < ranges else 0))
        planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in (ids[there], spares[there], steps, number[whose[a:b]])]
        raw = b"".join([np.array([b - a, there.sum()], np.uint32).tobytes(), *planes])
        out.append(np.uint64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True))
    return pa.RecordBatch.from_arrays([pa.array(which[edges[:-1]]), pa.array(out, pa.binary())], names=["range", "parts"])


def unpacked_parts(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts, from the start of their range, sets and spares of a row that packed_parts() gave."""
    raw = pa.decompress(packed[8:], int(np.frombuffer(packed[:8], np.uint64)[0]), codec="zstd", asbytes=True)
    n, m = np.frombuffer(raw[:8], np.uint32).tolist()

    def plane(count: int, kind: type, at: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8, count * size, at).reshape(size, count).T).view(kind)[:, 0]

    at = plane(n, np.uint32, 8 + 12 * m + 8 * n)
    return np.cumsum(plane(n, np.uint64, 8 + 12 * m)), plane(m, np.uint64, 8)[at], plane(m, np.uint32, 8 + 8 * m)[at]


def _parter(k: int, percent: int, bits: int, ranges: int):
    """Rows of packed_parts() of texts; of equal sets in a task those of the first, as far as it remembers. They are not stored, but shuffled at once."""

    def part_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        size = owners = 0
        for batch in batches:
            for _, sets, bounds in gram_sets(batch.column(0), k):
                fresh, ids = [], _set_ids(sets, bounds)
                for i, name in enumerate(ids.tolist()):
                    if name not in given:
                        given.add(name)
                        fresh.append(i)
                if len(given) > GIVEN_SETS:
                    given.clear()
                if not fresh:
                    continue
                n = np.diff(bounds)[fresh]
                values, whose, spares = signatures(np.concatenate([sets[bounds[i] : bounds[i + 1]] for i in fresh]), np.concatenate([[0], np.cumsum(n)]), percent)
                held.append((values, owners + whose, np.repeat(ids[fresh], 2), (2 * spares + np.arange(len(spares)) % 2).astype(np.uint32)))
                size += len(values)
                owners += 2 * len(fresh)
                if size > HELD_PARTS:
                    yield packed_parts(*(np.concatenate(x) for x in zip(*held)), bits, ranges)
                    held, size, owners = [], 0, 0
        if size:
            yield packed_parts(*(np.concatenate(x) for x in zip(*held)), bits, ranges)

    return part_batches


ALIKE = "part long, set_id long, spares int, sets int"
_MANY = np.iinfo(np.int32).max


def _alike(bits: int, ranges: int):
    """Of rows of packed_parts(), sorted by range: (part, set, spares, how many sets have the part) of parts that several sets have."""
    width = -(-(1 << bits) // ranges)

    def slices(which: int, held: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The range's parts in as many slices, by their hashes, as keep what is unpacked at a time small, whatever texts share."""
        many = -(-sum(int(np.frombuffer(packed[:8], np.uint64)[0]) for packed in held) // HELD_BYTES)
        for own in range(many):
            got = []
            for parts, ids, spares in map(unpacked_parts, held):
                at = (mix(parts + np.uint64(which)) % np.uint64(many)) == own if many > 1 else slice(None)
                got.append((parts[at], ids[at], spares[at]))
            yield tuple(np.concatenate(x) for x in zip(*got))

    def found(which: int, parts: np.ndarray, ids: np.ndarray, spares: np.ndarray) -> pa.RecordBatch:
        if which < ranges:  # most parts are of one set alone and go first
            order = np.argsort(parts, kind="stable")
            parts = parts[order]
            same = parts[1:] == parts[:-1]
            again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            parts, order = parts[again] + np.uint64(which * width), order[again]
            ids, spares = ids[order], spares[order]
        order = np.lexsort((spares, ids, parts))
        parts, ids, spares = parts[order], ids[order], spares[order]
        fresh = np.ones(len(parts), dtype=bool)
        fresh[1:] = (parts[1:] != parts[:-1]) | (ids[1:] != ids[:-1]) | (spares[1:] != spares[:-1])
        parts, ids, spares = parts[fresh], ids[fresh], spares[fresh]
        size = np.full(len(parts), _MANY)
        if which < ranges and len(parts):
            first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
            count = np.diff(np.append(first, len(parts)))
            size = np.repeat(np.where(np.minimum.reduceat(spares, first) == 0, _MANY, count), count)  # no set's spares are 0: that is the mark of a common part
        keep = (size > 1) & (spares > 0)
        arrays = [_longs(parts[keep]), _longs(ids[keep]), pa.array(spares[keep].astype(np.int32)), pa.array(size[keep].astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in ALIKE.split(", ")])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name != now and held:
                    yield from (found(now, *own) for own in slices(now, held))
                    held = []
                now = name
                held.append(packed.as_py())
        if held:
            yield from (found(now, *own) for own in slices(now, held))

    return alike


def candidate_edges(rows: DataFrame, k: int, percent: int, sets: int, grams: int) -> tuple[DataFrame, list[DataFrame]]:
    """Edges (a, b) over sets that connect any two with a link, unless they are equal; and the tables that they are read from.

    Of a set's parts on a level that other sets have as well, the most common ones but spares - 1 of them are left out:
    a link has `spares` or more in common, so of those that both sets have the rarest is kept by both. What very many
    texts share, lines or passages, thus makes no candidates, unless a text holds little else.
    """
    bits, ranges = part_bits(sets), max(1, grams * (100 - percent) // 35 // RANGE_PARTS)
    packed = rows.select("text").mapInArrow(_parter(k, percent, bits, ranges), "range long, parts binary").repartition("range").sortWithinPartitions("range")
    alike = materialize(packed.mapInArrow(_alike(bits, ranges), ALIKE), "alike")
    by_set = alike.groupBy("set_id", "spares").agg(F.sort_array(F.collect_set(F.struct("sets", "part")), asc=False).alias("parts"))
    kept = by_set.select("set_id", F.explode(F.slice("parts", F.floor(F.col("spares") / 2).cast("int"), F.greatest(F.size("parts"), F.lit(1)))["part"]).alias("part"))
    kept = materialize(kept, "kept")
    least = materialize(kept.groupBy("part").agg(F.min("set_id").alias("b")), "rarest")
    return kept.join(least.hint("merge"), "part").select(F.col("set_id").alias("a"), "b").filter("a <> b"), [alike, kept, least]


def overlap_links(sets: list[np.ndarray], others: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Pairs (i, j) of linked sets: i < j of sets, or i of sets and j of others.

    Overlaps are summed over blocks of columns of the incidence matrix, which holds n-grams of two documents or
    more. After each block a pair goes once its sum and what either set still has to come are too few for
    its sizes; when no pair is left, the rest of the columns is not multiplied.
    """
    left, right = sets, sets if others is None else others
    every = left if others is None else left + right
    n = np.array([len(x) for x in every], dtype=np.int64)
    flat, row = np.concatenate(every), np.repeat(np.arange(len(every)), n)
    _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df[column] > 1
    column, row = column[shared], row[shared]
    number = np.cumsum(df > 1) - 1
    column = number[column]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    rest = np.bincount(row, minlength=len(every))
    a, b = len(left), len(right)
    lo = 0 if others is None else a
    sizes = n[:a, None] + n[None, lo : lo + b]
    need = -(-percent * sizes // (100 + percent))
    alive = (np.minimum(n[:a, None], n[None, lo : lo + b]) >= need) & (need > 0)
    if others is None:
        alive &= np.triu(np.ones((a, b), dtype=bool), 1)
    counts = np.zeros((a, b), dtype=np.int64)
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, BLOCK_COLUMNS):
        i, j = np.searchsorted(column, [start, start + BLOCK_COLUMNS])
        dense = np.zeros((len(every), min(BLOCK_COLUMNS, total - start)), dtype=np.float32)
        dense[row[i:j], column[i:j] - start] = 1
        rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        counts[np.ix_(rows, columns)] += (dense[rows] @ dense[lo + columns].T).astype(np.int64)
        rest -= np.bincount(row[i:j], minlength=len(every))
        alive &= counts + np.minimum(rest[:a, None], rest[None, lo : lo + b]) >= need
        if not alive.any():
            break
    alive &= 100 * counts >= percent * (sizes - counts)
    return np.argwhere(alive)


def _spanning(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """As few of the pairs as connect what all of them connect."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def _multiplier(k: int, percent: int):
    """Rows (cluster, block, side, set_id, text), sorted by cluster and block; of side 1 to be held against side 0 alone."""

    def links(ids: list[int], sides: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        at = list({s: i for i, s in enumerate(ids) if not sides[i]}.values())
        other = list({s: i for i, s in enumerate(ids) if sides[i]}.values())
        if not other:
            pairs = overlap_links([sets[i] for i in at], None, percent) if len(at) > 1 else np.zeros((0, 2), np.int64)
            return [(ids[at[i]], ids[at[j]]) for i, j in _spanning(pairs, len(at))]
        pairs = overlap_links([sets[i] for i in at], [sets[i] for i in other], percent) if at else np.zeros((0, 2), np.int64)
        return [(ids[at[i]], ids[other[j - len(at)]]) for i, j in _spanning(pairs + [0, len(at)], len(at) + len(other))]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sides, sets = None, [], [], []
        for batch in batches:
            out: list[tuple[int, int]] = []
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            side, set_id = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            done = 0
            for docs, flat, bounds in gram_sets(batch.column(4), k):
                for i in range(docs):
                    if names[done + i] != key:
                        out += links(ids, sides, sets)
                        key, ids, sides, sets = names[done + i], [], [], []
                    ids.append(set_id[done + i])
                    sides.append(side[done + i])
                    sets.append(flat[bounds[i] : bounds[i + 1]])
                done += docs
            yield _edges(out)
        yield _edges(links(ids, sides, sets))

    def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return multiply


def _product(rows: DataFrame, k: int, percent: int) -> DataFrame:
    rows = rows.select("cluster", "block", "side", "set_id", "text").repartition("cluster", "block").sortWithinPartitions("cluster", "block")
    return rows.mapInArrow(_multiplier(k, percent), "a long, b long")


def document_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of id and text, by which the operator finds a document's row again."""
    return F.xxhash64(docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit("")))


def link_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, detail: bool = False) -> DataFrame:
    """Each document's doc_id, n_shingles and component_id: documents with 100 * intersection >= percent * union are linked.

    A document's set has its distinct shingles of `shingle` words (split at ASCII white space, A-Z lower-cased);
    a text of fewer words is one shingle; a null text, or one without words, has none and no link. component_id is
    the smallest id that links reach, the document's own included. Rows that repeat an id are documents of their
    own; a null id counts in no minimum, and the component of null ids alone is null. Other columns are not read.
    With detail also key (document_key() of the row) and group_id, which tells components of null ids apart; null without n-grams.

    1. Equal sets become one row of the matrix, so exact copies are never paired.
    2. Candidates, by size-derived bounds: sets with a link differ in so few n-grams that of so many parts of their
       n-grams some are alike. Sets that have one of their rarer parts in common fall into one cluster; sets of
       different clusters can have no link.
    3. A cluster's rows are dealt into blocks, a few pivots to all of them, and each block of the incidence
       matrix is multiplied by its transpose. Only as many links are given as connect what all links connect.
    4. What step 3 did not join to its cluster's largest component is held against all blocks of the cluster.
       Pairs inside that component need no product: they are connected. So no link is lost, and a group
       of near copies costs its size times what is not near its pivots, not its square.

    Texts are shuffled only of sets in clusters: those of others are held back by a filter of fixed size.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(document_key(docs, id_col, text_col).alias("key"), docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    sketch = materialize(rows.mapInArrow(_sketcher(shingle), SKETCH), "sketch")
    found = sketch.filter("n_shingles > 0")
    classes = materialize(found.groupBy("set_id").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("n_shingles").alias("n")), "classes")
    sets, grams = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    candidates, read = candidate_edges(rows, shingle, percent, sets, grams)
    clusters = connected_components(candidates)
    discard(*read)

    of_class = materialize(classes.join(clusters.withColumnsRenamed({"node": "set_id", "root": "cluster"}), "set_id").select("cluster", "set_id", "key", "n"), "members")
    discard(clusters)
    rank = lambda i: F.min(F.struct(F.xxhash64("set_id", F.lit(i)).alias("h"), "set_id"))["set_id"]
    sizes = of_class.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"), F.array_distinct(F.array(*[rank(i) for i in range(PIVOTS)])).alias("pivots"))
    sizes = materialize(sizes.withColumn("blocks", F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")), "sizes")
    own = F.pmod(F.xxhash64("set_id", F.lit("block")), F.col("blocks")).cast("int")
    blocks = F.when(F.array_contains("pivots", F.col("set_id")), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = of_class.join(sizes, "cluster").select("cluster", "set_id", "key", "blocks", own.alias("own"), blocks.alias("in_blocks"))
    among = may_be_among(of_class, "key")
    texts = rows.filter(among(F.col("key"))).select("key", "text").dropDuplicates(["key"])
    members = materialize(dealt.join(texts.hint("merge"), "key").drop("key"), "texts")

    inner = members.select("cluster", F.explode("in_blocks").alias("block"), F.lit(0).alias("side"), "set_id", "text")
    edges = materialize(_product(inner, shingle, percent), "links")
    spent = [of_class, sizes, members, edges]
    if sizes.filter("blocks > 1").limit(1).count():
        rest, read = _rest(members.filter("blocks > 1"), connected_components(edges), shingle, percent)
        edges = edges.unionByName(rest)
        spent += read
    reached = connected_components(edges)
    discard(*spent)

    of_set = classes.select("set_id", "least").join(reached.withColumnsRenamed({"node": "set_id"}), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    of_set = materialize(of_set, "sets")
    least = materialize(of_set.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    by_set = materialize(of_set.join(least.hint("merge"), "root").select("set_id", "component_id", F.col("root").alias("group_id")), "groups")
    discard(classes, reached, of_set, least)
    linked = found.join(by_set.hint("merge"), "set_id").select("doc_id", "n_shingles", "component_id", "key", "group_id")
    none = F.lit(None).cast("long").alias("group_id")
    out = linked.unionByName(sketch.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "key", none))
    return out if detail else out.drop("key", "group_id")


def _rest(members: DataFrame, reached: DataFrame, k: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links of sets outside their cluster's largest component with the sets of all its blocks; and the tables that give them."""
    state = members.select("cluster", "set_id").join(reached.withColumnsRenamed({"node": "set_id"}), "set_id", "left")
    state = materialize(state.withColumn("root", F.coalesce("root", "set_id")), "state")
    largest = state.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("cluster").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    largest = materialize(largest, "largest")
    outside = state.join(largest.hint("merge"), "cluster").filter("root <> main").select("cluster", "set_id")
    chunks = materialize(outside.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("int").alias("chunks")), "chunks")
    chunk = F.pmod(F.xxhash64("set_id", F.lit("chunk")), F.col("chunks")).cast("int")
    outside = materialize(outside.join(chunks.hint("merge"), "cluster").withColumn("chunk", chunk), "outside")
    name = lambda block, c: (F.col(block).cast("long") * (1 << 31) + F.col(c)).alias("block")
    right = members.join(outside.select("set_id", "chunk"), "set_id").withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = members.join(chunks.hint("merge"), "cluster").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pairs = left.select("cluster", name("own", "c"), F.lit(0).alias("side"), "set_id", "text").unionByName(
        right.select("cluster", name("b", "chunk"), F.lit(1).alias("side"), "set_id", "text")
    )
    return _product(pairs, k, percent), [reached, state, largest, chunks, outside]
