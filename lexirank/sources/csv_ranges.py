"""CSV files in ranges of bytes, so that one large file is read by many tasks although cells may hold line feeds.

A range alone can't tell whether it begins within quotes. One pass counts each range's quotes; sums of these, over the
ranges before it, tell where a range stands, and so which line feeds end records. The second pass parses: a range has
the records that begin in it, and reads on to the end of the last one.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.sizes import byte_size
from .places import file_system

#: Bytes of a range, unless the session's spark.sql.files.maxPartitionBytes are fewer.
RANGE_BYTES = 32 << 20
_MORE = 1 << 20
_QUOTE, _LF = 34, 10
_BOM = b"\xef\xbb\xbf"
#: What may stand before an opening quote, and after a closing one: a comma, an end of line, or a quote.
_BESIDE = np.isin(np.arange(256), [ord(c) for c in ',\n\r"'])
_PACKED = re.compile(r"\.(gz|gzip|bz2|zst|zstd|lz4|snappy|deflate|xz)$")


class BadRow(ValueError):
    """A file has a row that its header doesn't fit."""


def open_file(uri: str):
    fs, place = file_system(uri)
    return fs.open_input_file(place)


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files of a path (a file, a folder, or a pattern) and their sizes, by name; hidden ones and empty ones are left out."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for top in fs.globStatus(place) or []:
        for s in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
            if not s.isDirectory() and not s.getPath().getName().startswith(("_", ".")):
                found.append((s.getPath().toString(), s.getLen()))
    return sorted(f for f in found if f[1])


@dataclass(frozen=True)
class Ranges:
    """All ranges of some files, numbered through."""

    files: tuple[tuple[str, int], ...]
    size: int

    def __post_init__(self) -> None:
        counts = [-(-n // self.size) for _, n in self.files]
        object.__setattr__(self, "firsts", np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def of(self, number: int) -> tuple[int, int, int]:
        """The file's number, and the range's start and end in it."""
        file = int(np.searchsorted(self.firsts, number, side="right")) - 1
        start = (number - int(self.firsts[file])) * self.size
        return file, start, min(start + self.size, self.files[file][1])

    def tasks(self, spark: SparkSession) -> DataFrame:
        """Numbers of the ranges: one to a task, or as many as make up a range's size where files are small."""
        total = sum(n for _, n in self.files)
        least = min(len(self), spark.sparkContext.defaultParallelism)
        return spark.range(0, len(self), 1, max(1, min(len(self), max(least, -(-total // self.size)))))


def _counts(ranges: Ranges):
    """Of each range whether its quotes are odd, and how many stand where none should, if it begins outside of quotes and if within."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for number in batch.column(0).to_pylist():
                file, start, end = ranges.of(number)
                uri, size = ranges.files[file]
                before = min(start, 1)
                with open_file(uri) as f:
                    data = f.read_at(min(end + 1, size) - start + before, start - before)
                skip = 3 if not start and data.startswith(_BOM) else 0
                x = np.concatenate([np.frombuffer(data, np.uint8)[skip:], [_LF]]) if end == size else np.frombuffer(data, np.uint8)[skip:]
                x = x if before else np.concatenate([[_LF], x])
                at = np.flatnonzero(x[1 : end - start - skip + 1] == _QUOTE) + 1
                opens, closes = ~_BESIDE[x[at - 1]], ~_BESIDE[x[at + 1]]
                wrong = lambda first: int(opens[first::2].sum() + closes[1 - first :: 2].sum())
                rows.append((number, len(at) % 2, wrong(0), wrong(1)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["number", "odd", "outside", "within"])

    return count


def quoted_starts(spark: SparkSession, ranges: Ranges) -> np.ndarray | None:
    """Whether each range begins within quotes; None if a quote stands within an unquoted cell, or text follows a quoted one."""
    found = ranges.tasks(spark).mapInArrow(_counts(ranges), "number long, odd long, outside long, within long").toArrow().sort_by("number")
    odd, outside, within = (found[c].to_numpy() for c in ("odd", "outside", "within"))
    sums = np.concatenate([[0], np.cumsum(odd)])
    first = np.repeat(ranges.firsts[:-1], np.diff(ranges.firsts))
    inside = (sums[:-1] - sums[first]) % 2 == 1
    return inside if not np.where(inside, within, outside).any() else None


def _line_ends(x: np.ndarray, inside: bool) -> np.ndarray:
    """Places of the line feeds outside of quotes."""
    at = np.flatnonzero(x == _LF)
    return at[(np.searchsorted(np.flatnonzero(x == _QUOTE), at) + inside) % 2 == 0]


def records_of(file, size: int, start: int, end: int, inside: bool) -> bytes:
    """The bytes of the records that begin from start up to end; inside: whether start is within quotes."""
    before = min(start, 1)
    data = file.read_at(min(end, size) - start + before, start - before)
    x = np.frombuffer(data, np.uint8)
    at_first = inside ^ bool(before and x[0] == _QUOTE)
    ends = _line_ends(x, at_first)
    if before:
        if not len(ends) or ends[0] + 1 >= len(x):
            return b""
        first = int(ends[0]) + 1
    else:
        first = 3 if data.startswith(_BOM) else 0
    if len(ends) and ends[-1] == len(x) - 1:
        return data[first:]
    parts, at = [data[first:]], end
    within = bool((np.count_nonzero(x == _QUOTE) + at_first) % 2)
    while at < size:
        more = file.read_at(min(_MORE, size - at), at)
        x = np.frombuffer(more, np.uint8)
        ends = _line_ends(x, within)
        if len(ends):
            parts.append(more[: int(ends[0]) + 1])
            break
        parts.append(more)
        within ^= bool(np.count_nonzero(x == _QUOTE) % 2)
        at += len(more)
    return b"".join(parts)


def parsed(data: bytes, names: list[str], where: str, skip: int = 0) -> pa.Table:
    """Records as text, all cells of them; blank lines are skipped, a row of another width is an error."""
    read = pa_csv.ReadOptions(column_names=names, use_threads=False, block_size=len(data) + 1, skip_rows_after_names=skip)
    convert = pa_csv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False, quoted_strings_can_be_null=False)
    parse = pa_csv.ParseOptions(newlines_in_values=True)
    empty = pa.schema([(n, pa.string()) for n in names]).empty_table()
    if not data.strip(b"\r\n"):
        return empty
    try:
        return pa_csv.read_csv(pa.BufferReader(data), read, parse, convert)
    except pa.ArrowInvalid as x:
        if "UTF8" in str(x):
            return parsed(data.decode("utf-8", "replace").encode(), names, where, skip)
        raise BadRow(f"{where}: a row does not fit the header: {x}") from x


def header_of(file, size: int) -> list[str]:
    """The cells of the first record that isn't blank."""
    data = records_of(file, size, 0, min(size, 4096), False)
    if not data.strip(b"\r\n"):
        data = records_of(file, size, 0, size, False)
    return next(csv.reader(io.StringIO(data.lstrip(b"\r\n").decode("utf-8", "replace"), newline="")), [])


def _rows(ranges: Ranges, inside: bytes, names: list[str], where: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = [f"c{i}" for i in range(len(names))]
        kinds = pa.schema([(n, pa.string()) for n in names] + [(c, pa.int64()) for c in ("_file", "_start", "_row")])
        for batch in batches:
            for number in batch.column(0).to_pylist():
                file, start, end = ranges.of(number)
                uri, size = ranges.files[file]
                with open_file(uri) as f:
                    data = records_of(f, size, start, end, bool(inside[number]))
                data = data if start else data.lstrip(b"\r\n")  # the header comes first
                row = 0
                for part in parsed(data, plain, where, int(start == 0)).to_batches(10_000):
                    n = part.num_rows
                    order = [pa.array(np.full(n, file)), pa.array(np.full(n, start)), pa.array(np.arange(row, row + n))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *order], schema=kinds)
                    row += n

    return read


def read_ranges(spark: SparkSession, path: str, size: int | None = None) -> DataFrame | None:
    """Rows of CSV files with a header: every column as text, and _seq, their order by file name and place.

    None where ranges can't be told: files that are packed, that Arrow can't open, with columns that have no or the
    same name, with quotes within unquoted cells, or with text after quoted ones.
    """
    size = size or min(RANGE_BYTES, byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    files = files_of(spark, path)
    if not files or any(_PACKED.search(f) for f, _ in files):
        return None
    try:
        with open_file(files[0][0]) as f:
            names = header_of(f, files[0][1])
    except (OSError, ValueError, NotImplementedError):
        return None
    if not names or len({n.lower() for n in names}) < len(names) or not all(names):
        return None
    ranges = Ranges(tuple(files), size)
    inside = quoted_starts(spark, ranges)
    if inside is None:
        return None
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField(c, LongType()) for c in ("_file", "_start", "_row")])
    rows = ranges.tasks(spark).mapInArrow(_rows(ranges, inside.astype(np.uint8).tobytes(), names, path), schema)
    return rows.select(*[F.col(f"`{n}`") for n in names], F.struct("_file", "_start", "_row").alias("_seq"))
