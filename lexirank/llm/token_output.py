"""Token ids of documents, written in order of the document ids as files of packed blocks, and read back."""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import Remembered, pieces, runs
from .idfile import Reader, Writer
from .packing import ByteBpe
from .storage import importable, materialize, new_path
from .warc import _file_system

END_ID = 2
#: Token ids, and documents, of a file before the next one is begun.
FILE_IDS, FILE_DOCS = 1 << 24, 1 << 20
#: Distinct chunks whose ids a worker remembers.
HELD_CHUNKS = 150_000

FILES = "task long, part long, path string, n_docs long, n_ids long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class WordBpe:
    """Ids that the tokenizers library gives texts, for files of its BPE with word ends that cut at white space and drop it.

    White space belongs to no token, so the ids of a text are those of its chunks, and each distinct chunk of a block is
    worked on once. The file's normalizer is the library's own; its pattern gives the words; merges are done with the
    file's vocabulary as ranks, where MARK stands for the end of a word. What could be taken for a mark or has a special
    token's string in it goes to the library.
    """

    MARK, SPLIT = "\0", " "

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        added = [x["content"] for x in file["added_tokens"]]
        byte, end = ByteBpe.byte_of(), file["model"]["end_of_word_suffix"]
        ranks = {bytes(byte[c] for c in t.removesuffix(end)) + self.MARK.encode() * t.endswith(end): i for t, i in file["model"]["vocab"].items() if t not in added}
        self.merge = tiktoken.Encoding("word_bpe", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        (pattern,) = (p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(f"{pattern}|{self.SPLIT}").findall
        self.split_id = ranks[(self.SPLIT + self.MARK).encode()]
        self.odd = regex.compile("|".join([r"[^\S ]|[\x00\x1c-\x1f]", *map(regex.escape, added)])).search
        self.recent = re.compile("[^\0-\u1c7f]").search
        self.remembered = Remembered(self._work, self._forget, HELD_CHUNKS)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _normal(self, text: str) -> str:
        """NFC in lower case, letter by letter: by Python where it must agree with the library, whose tables may be of another year."""
        if self.recent(text) or not unicodedata.is_normalized("NFC", text):
            return self.library.normalizer.normalize_str(text)
        return text.replace("Σ", "σ").lower()

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that hold neither white space nor marks nor special tokens, and how many each has."""
        there = np.fromiter(map(bool, chunks), bool, len(chunks))
        lengths = np.zeros(len(chunks), np.int64)
        if not there.any():
            return np.zeros(0, np.uint32), lengths
        words = self.words(self._normal(self.SPLIT.join(filter(None, chunks))))  # an empty one would leave two spaces, which become one
        ids = np.array(self.merge(self.MARK.join([*words, self.SPLIT]) + self.MARK), np.uint32)
        ends = np.flatnonzero(ids == self.split_id)
        lengths[there] = np.diff(ends, prepend=-1) - 1
        return np.delete(ids, ends), lengths

    def _work(self, chunks: list[str]) -> None:
        odd = {}
        if self.odd(self.SPLIT.join(chunks)):
            odd = {i: self.library.encode(c, add_special_tokens=False).ids for i, c in enumerate(chunks) if self.odd(c)}
        plain, lengths = self._plain(["" if i in odd else c for i, c in enumerate(chunks)] if odd else chunks)
        if odd:
            at = np.cumsum(lengths) - lengths
            plain = np.insert(plain, np.concatenate([np.full(len(ids), at[i]) for i, ids in odd.items()]).astype(np.int64), [x for ids in odd.values() for x in ids])
            lengths[list(odd)] = [len(ids) for ids in odd.values()]
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids, self.lengths = np.concatenate([self.ids, plain.astype(np.uint32)]), np.concatenate([self.lengths, lengths])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        column = pc.replace_substring(pa.array(texts, pa.string()), "\n", " ")
        lists = pc.split_pattern(column, " ")
        slots = self.remembered.slots(lists.flatten())
        lengths = self.lengths[slots]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[runs(self.starts[slots], lengths)], np.diff(ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()])


_ENCODERS: dict[str, WordBpe] = {}


def _writer(folder: str, tokenizer_path: str, end_id: int, file_ids: int):
    def write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = WordBpe(tokenizer_path)
        encode = _ENCODERS[tokenizer_path].encode
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)
        out: Writer | None = None
        path, made, n_docs, open_ids = "", [], 0, 0

        def close() -> None:
            nonlocal out
            out.close()
            made.append((task, len(made), path, n_docs, out.n_ids))
            out = None

        for batch in batches:
            doc_ids = batch.column(0)
            nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
            doc_ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            for numbers, texts, last in pieces(batch.column(1).to_pylist()):
                if out is None:
                    name = f"ids-{task:06d}-{len(made):04d}-{uuid.uuid4().hex}.pfor"
                    path, n_docs = f"{folder}/{name}", 0
                    out = Writer(fs.open_output_stream(f"{root}/{name}", compression=None))
                ids, counts = encode(texts)
                over = np.array(last)
                out.ids(np.insert(ids, np.cumsum(counts)[over], end_id).astype(np.uint32))
                sums = np.concatenate([[open_ids], np.cumsum(counts + over) + open_ids])
                ends = sums[1:][over]
                starts = np.concatenate([[0], ends])
                rows = np.array(numbers)[over]
                out.documents(doc_ids[rows], nulls[rows], np.diff(starts))
                open_ids = int(sums[-1] - starts[-1])
                n_docs += len(rows)
                if open_ids == 0 and (out.n_ids >= file_ids or n_docs >= FILE_DOCS):
                    close()
        if out is not None:
            close()
        if made:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*made), kinds)], names=[f.split()[0] for f in FILES.split(", ")])

    return write_batches


def write_ids(docs: DataFrame, tokenizer_path: str, *, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all texts, each followed by end_id, in ascending order of document ids; a row for each file, with first_id.

    Rows without an id come first; rows of one id are ordered by a hash of their texts, and an id that very many rows
    have is dealt to several tasks. A null or empty text is its end_id alone. A text lies in one file whole; a file
    ends with the block of texts in which it reaches file_ids. Each task names files of its own and the table of files tells
    those of the tasks that counted, so tasks that run again, or twice, do no harm. Other columns are not read;
    an empty table gives no files.
    """
    importable(docs.sparkSession)
    folder = folder or new_path(docs.sparkSession, "ids")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", "_hash", "_row"]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = materialize(rows.mapInArrow(_writer(folder, tokenizer_path, end_id, file_ids), FILES), "id-files")
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "id-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fs, place = _file_system(path)
            with fs.open_input_file(place) as file:
                reader = Reader(file)
                ends = np.cumsum(reader.counts)
                starts, doc, at, crc = ends - reader.counts, 0, 0, 0
                for ids in reader.spans():
                    data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    till = int(np.searchsorted(ends, at + len(ids), side="right"))
                    sums = []
                    for a, b in zip(starts[doc:till].tolist(), ends[doc:till].tolist()):
                        sums.append(zlib.crc32(data[4 * max(a - at, 0) : 4 * (b - at)], crc if a < at else 0))
                    if till < len(ends):
                        a = int(starts[till])
                        crc = zlib.crc32(data[4 * max(a - at, 0) :], crc if a < at else 0)
                    if sums:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc_ids[doc:till], mask=reader.nulls[doc:till]), pa.array(starts[doc:till] + first), pa.array(reader.counts[doc:till]), pa.array(sums, pa.int64())],
                            names=[f.split()[0] for f in TOKENS.split(", ")],
                        )
                    doc, at = till, at + len(ids)


def read_ids(files: DataFrame) -> DataFrame:
    """A row of TOKENS for each document of the files (rows of what write_ids gave): its place, its number of ids and their checksum.

    A task reads whole files, in stretches of bounded size; the checksum is over the ids as little-endian 32-bit numbers.
    """
    dealt = files.select("path", "first_id").repartition(max(1, files.count()))
    return dealt.mapInArrow(_read, TOKENS)
