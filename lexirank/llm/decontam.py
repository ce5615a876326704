"""Benchmark decontamination: an FM-index per shard of documents, searched backwards for the windows of test items."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fmindex import SEPARATOR, FmIndex
from .storage import discard, importable, materialize, new_path
from .textbytes import ALNUM, words
from .warc import _file_system

WINDOW_WORDS = 13
#: Words in one FM-index.
SHARD_WORDS = 1_000_000
#: Characters of test items that one pass over the documents takes to every task; more items take more passes, each a stage of its own.
PASS_BYTES = 4 << 20


@dataclass
class Phrases:
    """Distinct windows of test items, by their number of words, over the vocabulary of the items."""

    vocabulary: np.ndarray
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    items: list[str | None]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], window: int) -> Phrases:
        hashes = []
        for block in words(pa.array([text for _, text in items], type=pa.string()), ALNUM):
            h = block.hashes()
            hashes += [h[a:b] for a, b in zip(block.bounds[:-1], block.bounds[1:])]
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        found: dict[int, dict[bytes, set[int]]] = {}
        for i, h in enumerate(hashes):
            ids = np.searchsorted(vocabulary, h).astype(np.int64) + 1
            k = min(window, len(ids))
            for at in range(len(ids) - k + 1 if k else 0):
                found.setdefault(k, {}).setdefault(ids[at : at + k].tobytes(), set()).add(i)
        by_length = {}
        for k, windows in found.items():
            owners = [sorted(x) for x in windows.values()]
            by_length[k] = (
                np.frombuffer(b"".join(windows), np.int64).reshape(-1, k),
                np.concatenate([[0], np.cumsum([len(x) for x in owners])]),
                np.array([i for x in owners for i in x], dtype=np.int64),
            )
        return cls(vocabulary, by_length, [None if name is None else str(name) for name, _ in items])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, from 1; 0 for words that no item has."""
        if not hasattr(self, "_seen"):
            self._seen = np.zeros(1 << 16, dtype=bool)
            self._seen[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        out = np.zeros(len(hashes), dtype=np.int64)
        may = np.flatnonzero(self._seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[may]), len(self.vocabulary) - 1)
        out[may] = np.where(self.vocabulary[at] == hashes[may], at + 1, 0)
        return out


def occurrences(numbers: np.ndarray, bounds: np.ndarray, phrases: Phrases, shard: int = SHARD_WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Where windows stand in documents (numbers: of their words, bounds: of documents): window length, windows, first words.

    No window can stand across a word that no item has, so only runs of the items' words are indexed, and
    of those only such as are as long as the shortest window. Runs beyond a shard's size overlap into the next.
    """
    if not phrases.by_length or not len(numbers):
        return
    least, most = min(phrases.by_length), max(phrases.by_length)
    valid = numbers > 0
    opens, closes = valid.copy(), valid.copy()
    opens[1:] &= ~valid[:-1]
    closes[:-1] &= ~valid[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(numbers))]
    opens[edge] = valid[edge]
    closes[edge - 1] = valid[edge - 1]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    a, b = a[b - a >= least], b[b - a >= least]
    if not len(a):
        return
    size = b - a + 1
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) - np.repeat(ends - size - a, size)
    text = np.where(place < np.repeat(b, size), numbers[np.minimum(place, len(numbers) - 1)], SEPARATOR)
    sigma = len(phrases.vocabulary) + 1
    for start in range(0, len(text), shard):
        part = np.concatenate([text[start : start + shard + most - 1], [SEPARATOR]])
        index = FmIndex(part, sigma)
        for k, (windows, _, _) in phrases.by_length.items():
            low, high = index.search(windows)
            count = high - low
            which = np.repeat(np.arange(len(windows)), count)
            rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
            if len(rows):
                yield k, which, place[start + index.locate(rows)]


MARK_FIELDS = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


#: The phrases that this worker read last, by their file.
_READ: dict[str, Phrases] = {}


def stored(spark: SparkSession, phrases: Phrases) -> str:
    """The phrases as a file of the shared folder: closures stay small, and a worker reads them once."""
    path = new_path(spark, "phrases")
    fs, place = _file_system(path)
    fs.create_dir(place.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(place, compression=None) as out:
        out.write(pickle.dumps(phrases, protocol=5))
    return path


def read_phrases(path: str) -> Phrases:
    if path not in _READ:
        _READ.clear()
        fs, place = _file_system(path)
        with fs.open_input_stream(place, compression=None) as file:
            _READ[path] = pickle.loads(file.read())
    return _READ[path]


def _marker(path: str):
    def mark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = read_phrases(path)
        for batch in batches:
            texts = batch.column(batch.schema.names.index("_text"))
            n_words, n_hit, items, spans = [], [], [], []
            for block in words(texts, ALNUM):
                numbers, doc = phrases.numbers(block.hashes()), block.doc()
                edges = np.zeros(len(numbers) + 1, dtype=np.int64)
                pairs = [np.zeros((0, 2), np.int64)]
                for k, which, first in occurrences(numbers, block.bounds, phrases):
                    np.add.at(edges, first, 1)
                    np.add.at(edges, first + k, -1)
                    _, owner_at, owners = phrases.by_length[k]
                    n = owner_at[which + 1] - owner_at[which]
                    each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - owner_at[which], n)
                    pairs.append(np.unique(np.stack([np.repeat(doc[first], n), owners[each]], 1), axis=0))
                hit = np.cumsum(edges[:-1]) > 0
                n_words += block.counts().tolist()
                n_hit += np.bincount(doc[hit], minlength=block.docs).tolist()
                block_items: list[list[str]] = [[] for _ in range(block.docs)]
                for d, i in np.unique(np.concatenate(pairs), axis=0).tolist():
                    if phrases.items[i] is not None:
                        block_items[d].append(phrases.items[i])
                items += [sorted(set(x)) for x in block_items]
                block_spans: list[list[dict]] = [[] for _ in range(block.docs)]
                at = np.flatnonzero(hit)
                if len(at):
                    opens = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])])
                    closes = np.concatenate([opens[1:], [True]])
                    letters = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                    for x, y in zip(at[opens], at[closes]):
                        zero = letters[block.base[doc[x]]]
                        block_spans[doc[x]].append({"start": int(letters[block.starts[x]] - zero), "end": int(letters[block.ends[y]] - zero)})
                spans += block_spans
            keep = [name for name in batch.schema.names if name != "_text"]
            arrays = [batch.column(batch.schema.names.index(name)) for name in keep]
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays += [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_words", "n_hit", "items", "spans"])

    return mark_batches


def _passes(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """What of each document stands in test items: doc (a struct of its columns), n_words, n_hit, items, spans.

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. A window is `window`
    words in a row of an item; an item of fewer words is one window, one of none has none. n_hit counts words
    in occurrences of windows; items are the ids (as strings, sorted, distinct) of items with an occurrence;
    spans are the merged runs of hit words, to be removed, in code points of the text, end exclusive.
    Documents stay where they are: no shuffle. A null or empty text has no words; repeated rows are marked
    each; an item with a null id marks words but is not listed; empty tables give no rows, or no hits.
    Items over `pass_bytes` go out in several passes: each reads what the one before wrote, and their spans are merged.
    """
    if pass_bytes < 1:
        raise ValueError("a pass takes a byte of items or more")
    spark, kinds, out = docs.sparkSession, T.StructType.fromDDL(MARK_FIELDS).fields, None
    importable(spark)
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    for block in _passes(benchmark, item_col, item_text_col, pass_bytes):
        if out is not None:
            before, out = out, materialize(out, "marked")
            if hasattr(before, "_spent"):
                discard(before._spent)
        rows = plain if out is None else out.withColumnsRenamed({f.name: f"_{f.name}" for f in kinds})
        marked = _pass(rows, Phrases.of(block, window), text_col, kinds)
        merged = marked if out is None else _merged(marked, text_col)
        if out is not None:
            merged._spent = out
        out = merged
    return _pass(plain, Phrases.of([], 1), text_col, kinds) if out is None else out


def _pass(rows: DataFrame, phrases: Phrases, text_col: str, kinds: list) -> DataFrame:
    rows = rows.withColumn("_text", F.col("doc").getField(text_col).cast("string"))
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "_text"), *kinds])
    return rows.mapInArrow(_marker(stored(rows.sparkSession, phrases)), schema)


def _merged(marked: DataFrame, text_col: str) -> DataFrame:
    """Two passes as one: spans that overlap, or have no other word between them, become one, and their words are counted again."""
    text = F.col("doc").getField(text_col).cast("string")
    meet = lambda a, b: (a >= b) | ~F.substring(text, (a + 1).cast("int"), (b - a).cast("int")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    both = F.array_sort(F.concat("_spans", "spans"))
    spans = F.aggregate(
        both,
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & meet(F.element_at(done, -1)["end"], s["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    counted = F.aggregate(
        "spans",
        F.lit(0).cast("long"),
        lambda n, s: n + F.size(F.regexp_extract_all(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))),
    )
    out = marked.withColumn("items", F.array_sort(F.array_union("_items", "items"))).withColumn("spans", spans)
    return out.select("doc", "n_words", counted.alias("n_hit"), "items", "spans")


def is_contaminated() -> Column:
    """At least a twentieth of the words, and any, are hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its spans (in order, apart, in code points)."""
    rest = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(F.concat(s["kept"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))).alias("kept"), x["end"].alias("at")),
    )
    return F.concat(rest["kept"], F.substring(text, (rest["at"] + 1).cast("int"), F.length(text)))
