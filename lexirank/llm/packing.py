"""Packing of tokenized documents into windows: best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
WINDOW = 2048
#: Ids held in a task before what it has is packed and given out: memory is bounded whatever a partition holds.
HELD_IDS = 12_000_000
#: Distinct chunks of text whose ids a worker remembers.
HELD_CHUNKS = 400_000

PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class CapacityTree:
    """Open windows by remaining capacity. A node tells how many open windows its range of capacities holds."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The open window with the least capacity of at least need, removed; None if none has so much."""
        count, i = self.count, need + self.size
        while not count[i]:
            while i & 1:
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            if i >= 2 * self.size:
                return None
        while i < self.size:
            i *= 2
            if not count[i]:
                i += 1
        capacity = i - self.size
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int], int]:
    """For each length (1 to window) the window it goes to and its offset there; and the number of windows."""
    tree, sequences, offsets, made = CapacityTree(window), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        found = tree.take(lengths[i])
        if found is None:
            found, made = (window, made), made + 1
        capacity, sequences[i] = found
        offsets[i] = window - capacity
        if capacity > lengths[i]:
            tree.add(capacity - lengths[i], sequences[i])
    return sequences, offsets, made


class ByteBpe:
    """Ids of a byte-level BPE file of the tokenizers library, as its encode(add_special_tokens=False) gives them.

    Its pre-tokens never cross a single space or line feed between other characters, so chunks cut there
    have ids of their own, and those of a chunk seen before are looked up. The merges of new chunks are
    done with the file's vocabulary as ranks; a text that holds a special token's string goes whole to the library.
    """

    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = {x["content"] for x in file["added_tokens"]}
        byte = self.byte_of()
        ranks = {bytes(byte[c] for c in token): rank for token, rank in file["model"]["vocab"].items() if token not in added}
        self.merge = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = re.compile("|".join(map(re.escape, sorted(added))) or r"(?!)")
        self.odd = re.compile(r"\s\s|\s\Z|\A\s")
        self.known: dict[str, bytes] = {}

    @staticmethod
    def byte_of() -> dict[str, int]:
        """The byte that each character of a byte-level token stands for."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text, each as four bytes, least first."""
        if not text:
            return b""
        if self.special.search(text):
            return self._bytes(self.library.encode(text, add_special_tokens=False).ids)
        if self.odd.search(text):
            return self._bytes(self.merge(text))
        if len(self.known) > HELD_CHUNKS:
            self.known.clear()
        chunks = text.replace("\n", " \n").replace(" ", "\0 ").replace("\0 \n", "\0\n\0").split("\0") if "\0" not in text else [text]
        known = self.known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            for c in chunks:
                if c not in known:
                    known[c] = self._bytes(self.merge(c))
            return b"".join(map(known.__getitem__, chunks))


_ENCODERS: dict[str, ByteBpe] = {}


def _packer(tokenizer_path: str, window: int):
    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = ByteBpe(tokenizer_path)
        encode, end = _ENCODERS[tokenizer_path].encode, struct.pack("<I", END_ID)
        task = TaskContext.get()
        made, held, pieces = (task.partitionId() if task else 0) << 36, 0, []
        names = [f.split()[0] for f in PACKED.split(", ")]

        def packed() -> pa.RecordBatch:
            nonlocal made
            tail = [i for i, p in enumerate(pieces) if p[2] < window]
            at, offset, used = best_fit_decreasing([pieces[i][2] for i in tail], window)
            place = dict(zip(tail, zip(at, offset)))
            rows, full = [], made + used
            for i, (doc, start, length, tokens, ids) in enumerate(pieces):
                if i in place:
                    rows.append((doc, start, length, tokens, made + place[i][0], place[i][1], ids))
                else:
                    rows.append((doc, start, length, tokens, full, 0, ids))
                    full += 1
            made = full
            kinds = [pa.int64()] * 6 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                tokens = len(ids) // 4
                for start in range(0, tokens, window):
                    length = min(window, tokens - start)
                    pieces.append((doc, start, length, tokens, ids[4 * start : 4 * (start + length)]))
                held += tokens
                if held >= HELD_IDS:
                    yield packed()
                    held, pieces = 0, []
        if pieces:
            yield packed()

    return pack_batches


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, packed into windows of at most `window` ids: columns of PACKED.

    A document is the ids of its text and END_ID; a null or empty text gives END_ID alone. Overlong documents
    are cut into full windows; what remains of each goes, longest first, to the tightest open window of its task,
    so there is no shuffle, and each task leaves one or two windows that are not full. Repeated rows and
    equal or null ids are packed as rows of their own; other columns are not read; an empty table gives no pieces.
    A task that runs again makes the same pieces under the same sequence ids.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_packer(tokenizer_path, window), PACKED)
