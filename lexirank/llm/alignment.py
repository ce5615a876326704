"""Alignment of two tokenizers' tokens by the bytes they stand for, and how often their ids meet in a corpus.

Every byte of a text has a label: `0`, `1` where a token of A ends, `2` where one of B ends, `3` where both do. A group of
tokens is a run up to the next `3`; each label but `0` is a link, of the two tokens that lie over that byte.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Remembered, pieces, runs
from .packing import ByteBpe
from .storage import importable, materialize

#: Distinct chunks whose alignment a worker remembers.
HELD_CHUNKS = 60_000
#: Pairs of ids whose counts every task holds, the commonest ones; the others' come by a join.
HELD_PAIRS = 1 << 18

FACTS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
LOOKED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<long>"

_GROUP = re.compile(rb"[012]*3")
_SPACE = r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Texts in which white space is not between two other characters.
_ODD = rf"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$"
_ALONE = re.compile(r"(?<=\S) (?=\S)")


class Tokens:
    """One tokenizer: the ids of a chunk, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        if path.endswith(".json"):
            self.encode, self.bytes = self._byte_level(path)
        else:
            self.encode, self.bytes = self._pieces(path)
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    @staticmethod
    def _byte_level(path: str):
        bpe = ByteBpe(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte = ByteBpe.byte_of()
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            table[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        return lambda chunks: [bpe.merge(c) for c in chunks], table

    @staticmethod
    def _pieces(path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            hexed = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            table.append(bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode())
        space = model.piece_to_id("▁")

        def encode(chunks: list[str]) -> list[list[int]]:
            """The space that the model puts before a chunk is the chunk's own, if it has one; a glued chunk lacks it."""
            found = model.encode([c[1:] if c.startswith(" ") else c for c in chunks], num_threads=1)
            return [ids if c.startswith(" ") else ids[1:] if ids[:1] == [space] else [] for c, ids in zip(chunks, found)]

        return encode, table


def label_string(n_bytes: int, a_ends: np.ndarray, b_ends: np.ndarray) -> bytes:
    labels = np.full(n_bytes, 48, np.uint8)
    labels[a_ends - 1] += 1
    labels[b_ends - 1] += 2
    return labels.tobytes()


class Aligner:
    """Alignments of distinct chunks, kept as columns: a slot for each chunk.

    Neither tokenizer has a token that crosses a lone space, or a line feed between other characters, so a chunk's
    tokens are the same wherever it stands, and both have one that ends with it.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = Tokens(path_a), Tokens(path_b)
        self.b_ids = len(self.b.bytes)
        self.text_a = list(map(str, range(len(self.a.bytes))))
        self.text_b = list(map(str, range(self.b_ids)))
        self.remembered = Remembered(self._work, self._forget, HELD_CHUNKS)
        self._forget()

    def _forget(self) -> None:
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)
        self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def _text(key: str) -> str:
        """The bytes' text of a chunk: one that begins with a single line feed stands as it is, others follow a space."""
        return " " + key[2:] if key.startswith("\n\n") else key if key.startswith("\n") else " " + key

    def _work(self, keys: list[str]) -> None:
        chunks = list(map(self._text, keys))
        found_a, found_b = self.a.encode(chunks), self.b.encode(chunks)
        texts = [c.encode() for c in chunks]
        bytes_a, bytes_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        right = [b"".join(map(bytes_a, x)) == t and b"".join(map(bytes_b, y)) == t for x, y, t in zip(found_a, found_b, texts)]
        if not all(right):
            found_a, found_b, texts = ([x if ok else x[:0] for x, ok in zip(c, right)] for c in (found_a, found_b, texts))
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        n_a, n_b = (np.fromiter(map(len, f), np.int64, len(f)) for f in (found_a, found_b))
        ids_a, ids_b = ([i for ids in f for i in ids] for f in (found_a, found_b))
        flat_a, flat_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        labels = label_string(int(size.sum()), np.cumsum(self.a.lengths[flat_a]), np.cumsum(self.b.lengths[flat_b]))
        text_a, text_b = list(map(self.text_a.__getitem__, ids_a)), list(map(self.text_b.__getitem__, ids_b))
        made, at_a, at_b, places = [], 0, 0, []
        for group in _GROUP.finditer(labels):
            span = group[0]
            both = span.count(b"1"), span.count(b"2")
            to_a, to_b = at_a + both[0] + 1, at_b + both[1] + 1
            made.append(",".join(text_a[at_a:to_a]) + "|" + ",".join(text_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
            places.append(group.end())
        ends = np.cumsum(size)
        bounds = np.searchsorted(np.array(places, np.int64), np.concatenate([[0], ends]), side="right").tolist()
        self.groups += [";".join(made[p:q]) for p, q in zip(bounds, bounds[1:])]
        marks = np.frombuffer(labels, np.uint8)
        at = np.flatnonzero(marks > 48)
        step_a, step_b = (marks[at] & 1).astype(np.int64), (marks[at] >> 1 & 1).astype(np.int64)
        new = flat_a[np.cumsum(step_a) - step_a] * self.b_ids + flat_b[np.cumsum(step_b) - step_b]
        links = np.searchsorted(at, np.concatenate([[0], ends]))
        n_groups = np.where(right, np.diff(bounds), -1)
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_groups, np.diff(links)], axis=1)])
        self.starts = np.concatenate([self.starts, len(self.pairs) + links[:-1]])
        self.pairs = np.concatenate([self.pairs, new])

    def _keys(self, texts: list[str], odd: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Chunks of texts, and their bounds."""
        column = pa.array(texts, pa.string())
        column = pc.if_else(pa.array(odd), pa.scalar("", pa.string()), column)
        lists = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        if not odd.any():
            return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        plain = lists.to_pylist()
        own = [["\n\n" + c for c in _ALONE.split(t)] if o else p for t, o, p in zip(texts, odd.tolist(), plain)]
        return pa.array([c for x in own for c in x], pa.string()), np.concatenate([[0], np.cumsum(list(map(len, own)))])

    def block(self, texts: list[str], odd: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: n_a, n_b, n_groups, n_links, and whether its tokens' bytes aren't its own; groups; sorted pairs with the text's number first, and times."""
        keys, bounds = self._keys(texts, odd)
        slots = self.remembered.slots(keys)
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.numbers[slots], axis=0)])
        totals = sums[bounds[1:]] - sums[bounds[:-1]]
        wrong = np.bincount(doc, self.numbers[slots, 2] < 0, len(texts)) > 0
        group = self.groups.__getitem__
        groups = [";".join(map(group, slots[a:b].tolist())) for a, b in zip(bounds, bounds[1:])]
        used, n = np.unique(doc * len(self.groups) + slots, return_counts=True)
        doc, slot = np.divmod(used, len(self.groups))
        lengths = self.numbers[slot, 3]
        all_pairs = len(self.a.bytes) * self.b_ids
        key = np.repeat(doc, lengths) * all_pairs + self.pairs[runs(self.starts[slot], lengths)]
        order = np.argsort(key)
        key, times = key[order], np.repeat(n, lengths)[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.add.reduceat(times, first) if len(first) else first
        doc, pair = np.divmod(key[first], all_pairs)
        return np.column_stack([totals, wrong]), groups, doc, pair, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))


def _aligned(path_a: str, path_b: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        aligner, task = _ALIGNERS[path_a, path_b], TaskContext.get()
        row = (task.partitionId() if task else 0) << 36
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            odd = pc.match_substring_regex(texts, _ODD).fill_null(False).to_numpy(zero_copy_only=False)
            open_: list = []
            for numbers, parts, last in pieces(texts.to_pylist()):
                here = odd[numbers]
                if open_ or not all(last):
                    # a text of several parts is put together when its last one is there
                    for k, number in enumerate(numbers):
                        open_.append(aligner.block([parts[k]], here[k : k + 1]))
                        if last[k]:
                            yield _facts([doc_ids[number]], row, *_joined(open_), np.array([not parts[k] and len(open_) == 1]))
                            row += 1
                            open_ = []
                else:
                    found = aligner.block(parts, here)
                    yield _facts([doc_ids[i] for i in numbers], row, *found, np.array([not p for p in parts]))
                    row += len(numbers)

    return align


def _joined(parts: list) -> tuple:
    if len(parts) == 1:
        return parts[0]
    numbers = sum(p[0] for p in parts)
    pair, at = np.unique(np.concatenate([p[3] for p in parts]), return_inverse=True)
    times = np.zeros(len(pair), np.int64)
    np.add.at(times, at, np.concatenate([p[4] for p in parts]))
    return numbers, [";".join(p[1][0] for p in parts)], np.zeros(len(pair), np.int64), pair, times


def _facts(doc_ids: list, row: int, numbers: np.ndarray, groups: list[str], doc: np.ndarray, pair: np.ndarray, times: np.ndarray, empty: np.ndarray) -> pa.RecordBatch:
    none = empty | (numbers[:, 4] > 0)
    values = np.where(none[:, None], 0, numbers[:, :4])
    digests = ["" if x else hashlib.sha256(g.encode()).hexdigest() for x, g in zip(none.tolist(), groups)]
    kept = ~none[doc]
    bounds = np.searchsorted(doc[kept], np.arange(len(doc_ids) + 1))
    columns = [pa.array(np.arange(len(doc_ids)) + row), pa.array(doc_ids, pa.int64()), *[pa.array(values[:, k]) for k in range(4)], pa.array(digests, pa.string()), _lists(bounds, pair[kept]), _lists(bounds, times[kept])]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FACTS.split(", ")])


def align(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row of FACTS for each document: numbers of tokens, groups and links, a digest of the groups, and its linked pairs with their times.

    A is a byte-level file of the tokenizers library, B a model of sentencepiece that puts a space before a text; both
    see strings of special tokens as plain text. A pair is a number: A's id times the size of B's vocabulary, plus B's
    id. Texts that are null or empty, or whose tokens' bytes aren't the text's own after a space, have no tokens:
    zeros, an empty digest and no pairs. Rows that repeat are rows of their own, known by `row`; other columns are not read.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_aligned(path_a, path_b), FACTS)


def pair_counts(facts: DataFrame, b_ids: int) -> DataFrame:
    """Of each pair the number of documents that hold it (n), and whether no pair of its A id has more (best).

    There are at most as many rows to broadcast as A has ids.
    """
    counts = materialize(facts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a = F.expr(f"pair div {b_ids}")
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    with_a = counts.withColumn("a", a)
    return materialize(with_a.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _commonest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (sorted), counts and marks of all pairs with at least some count, at most `most` of them; and that count."""
    level = F.floor(F.log2("n") * 16).cast("int")
    least, held = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect(), reverse=True):
        held += r.k
        if held > most:
            break
        least = r.n
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), 1 << 62
    found = counts.filter(F.col("n") >= least).toArrow()
    pair = found["pair"].to_numpy()
    order = np.argsort(pair)
    return pair[order], found["n"].to_numpy()[order], found["best"].to_numpy()[order], least


def _looked_up(held: Broadcast):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = held.value
        for batch in batches:
            lists = batch.column(7)
            bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            pair, times = (batch.column(k).flatten().to_numpy() for k in (7, 8))
            at = np.searchsorted(pairs, pair)
            there = (at < len(pairs)) & (pairs[np.minimum(at, len(pairs) - 1)] == pair) if len(pairs) else np.zeros(len(pair), bool)
            at = np.where(there, at, 0)
            sums = []
            for weight in (best, counts):
                value = np.where(there, weight[at] * times, 0) if len(pairs) else np.zeros(len(pair), np.int64)
                total = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]], pa.int64()))
            rare = np.concatenate([[0], np.cumsum(~there)])[bounds]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(7)), *sums, _lists(rare, pair[~there]), _lists(rare, times[~there])], names=[f.split()[0] for f in LOOKED.split(", ")])

    return look


def with_counts(facts: DataFrame, counts: DataFrame, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """Rows of FACTS with n_best and count_sum in place of their pairs.

    Tasks hold the counts of the commonest pairs, at most held_pairs, whatever the corpus; those of the others come by a
    join whose sides are written tables. A document is one row of a written table, known by its number.
    """
    *table, least = _commonest(counts, held_pairs)
    held = facts.sparkSession.sparkContext.broadcast(tuple(table))
    looked = materialize(facts.mapInArrow(_looked_up(held), LOOKED), "looked-up")
    rare = looked.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    others = counts.filter(F.col("n") < least).hint("merge")
    found = rare.join(others, "pair").groupBy("row").agg(F.sum(F.col("best").cast("long") * F.col("times")).alias("_best"), F.sum(F.col("n") * F.col("times")).alias("_sum"))
    found = materialize(found, "rare-pairs")
    both = looked.join(found.hint("merge"), "row", "left")
    add = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c)
    return both.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "_best"), add("count_sum", "_sum"), "groups_sha256")


def aligned_with_counts(docs: DataFrame, path_a: str, path_b: str, held_pairs: int = HELD_PAIRS, **columns: str) -> DataFrame:
    """align(), with n_best and count_sum from counts over all the documents; an empty table gives no rows."""
    facts = materialize(align(docs, path_a, path_b, **columns), "alignments")
    counts = pair_counts(facts, len(Tokens(path_b).bytes))
    return with_counts(facts, counts, held_pairs)
