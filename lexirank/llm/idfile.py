"""A file of token ids: blocks in patched frame-of-reference coding, and an index of block starts and documents.

    file    MAGIC, blocks, index, footer
    block   1,024 ids less the block's minimum: their low `width` bits in 32-bit words, 32 lanes side by side; then
            the exceptions, whose rest is more than 0: places (16 bits each), then rests (32 bits each)
    index   starts of blocks and the end of the last (64 bits), minima (32), counts of exceptions (16), widths (8);
            of documents: ids (64), counts of token ids (64), whether the id is null (8)
    footer  numbers of blocks, documents and token ids, start of the index (64 bits each), CRC-32 of the index (32), MAGIC

All numbers are little-endian. The last block is filled up with its own minimum.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"PFORIDS1"
LANES = 32
VALUES = LANES * 32
#: A block's width is that of one of these percentiles of its values, whichever makes the block smallest.
PERCENTILES = (50, 75, 90, 95, 98, 100)
_FOOTER = struct.Struct("<QQQQI8s")


def bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits that values under 2^32 take."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of VALUES numbers under 2^width as rows of width * LANES words."""
    v = values.reshape(-1, 32, LANES)
    out = np.zeros((len(v), width, LANES), np.uint32)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        out[:, word] |= v[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= v[:, i] >> np.uint32(32 - shift)
    return out.reshape(len(v), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(len(words), width, LANES)
    out = np.zeros((len(w), 32, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        x = w[:, word] >> np.uint32(shift)
        if shift + width > 32:
            x = x | (w[:, word + 1] << np.uint32(32 - shift))
        out[:, i] = x & mask
    return out.reshape(len(w), VALUES)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of ids, whose number is a multiple of VALUES: bytes, minima, widths and numbers of exceptions of each."""
    x = ids.reshape(-1, VALUES)
    minima = x.min(axis=1)
    x = x - minima[:, None]
    ordered = np.sort(x, axis=1)
    best = np.full(len(x), np.iinfo(np.int64).max)
    widths, rests = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for p in PERCENTILES:
        width = bit_lengths(ordered[:, -(-p * VALUES // 100) - 1])
        left = (x >> np.minimum(width, 31).astype(np.uint32)[:, None] > 0).sum(axis=1) * (width < 32)
        cost = 4 * LANES * width + 6 * left
        better = cost < best
        best[better], widths[better], rests[better] = cost[better], width[better], left[better]
    out: list[bytes] = [b""] * len(x)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        values = x[rows]
        words = pack(values & np.uint32((1 << width) - 1), width)
        high = values >> np.uint32(width) if width < 32 else np.zeros_like(values)
        row, place = np.nonzero(high)
        bounds = np.searchsorted(row, np.arange(len(rows) + 1))
        place, high = place.astype("<u2"), high[row, place].astype("<u4")
        for k, at in enumerate(rows.tolist()):
            a, b = bounds[k], bounds[k + 1]
            out[at] = words[k].astype("<u4", copy=False).tobytes() + place[a:b].tobytes() + high[a:b].tobytes()
    return out, minima, widths, rests


def decode_blocks(data: bytes, starts: np.ndarray, minima: np.ndarray, widths: np.ndarray, rests: np.ndarray) -> np.ndarray:
    """The ids of blocks that begin at `starts` in data."""
    out = np.zeros((len(starts), VALUES), np.uint32)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        if width:
            words = [np.frombuffer(data, "<u4", width * LANES, s) for s in starts[rows].tolist()]
            out[rows] = unpack(np.stack(words), width)
    for k in np.flatnonzero(rests).tolist():
        width, n = int(widths[k]), int(rests[k])
        at = int(starts[k]) + 4 * LANES * width
        out[k, np.frombuffer(data, "<u2", n, at)] |= np.frombuffer(data, "<u4", n, at + 2 * n) << np.uint32(width)
    return (out + minima[:, None]).reshape(-1)


class Writer:
    """Writes one file to an open stream: documents' ids in order, blocks as soon as they are full."""

    def __init__(self, out) -> None:
        self.out, self.at, self.n_ids = out, 0, 0
        self.rest = np.zeros(0, np.uint32)
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def ids(self, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        held = np.concatenate([self.rest, ids])
        full = len(held) // VALUES * VALUES
        self._blocks(held[:full])
        self.rest = held[full:]

    def documents(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray) -> None:
        """Documents that end with the ids given so far, in order."""
        self.docs.append((doc_ids, counts, nulls))

    def _blocks(self, ids: np.ndarray) -> None:
        if len(ids):
            data, minima, widths, rests = encode_blocks(ids)
            sizes = np.fromiter(map(len, data), np.int64, len(data))
            self.blocks.append((self.at + np.cumsum(sizes) - sizes, minima, rests, widths))
            self._put(b"".join(data))

    def close(self) -> None:
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.full(-len(self.rest) % VALUES, self.rest.min(), np.uint32)]))
        starts, minima, rests, widths = (np.concatenate([b[k] for b in self.blocks] or [np.zeros(0, np.int64)]) for k in range(4))
        doc_ids, counts, nulls = (np.concatenate([d[k] for d in self.docs] or [np.zeros(0, np.int64)]) for k in range(3))
        columns = [(np.append(starts, self.at), "<u8"), (minima, "<u4"), (rests, "<u2"), (widths, "u1"), (doc_ids, "<i8"), (counts, "<u8"), (nulls, "u1")]
        index, at = b"".join(c.astype(kind).tobytes() for c, kind in columns), self.at
        self._put(index)
        self._put(_FOOTER.pack(len(starts), len(doc_ids), self.n_ids, at, zlib.crc32(index), MAGIC))
        self.out.close()


class Reader:
    """Reads a file by its index: any range of ids costs the blocks that hold it."""

    def __init__(self, file) -> None:
        """file: an open file with size() and read_at(bytes, start), as those of pyarrow.fs."""
        self.file = file
        size = file.size()
        foot = file.read_at(_FOOTER.size, size - _FOOTER.size) if size >= _FOOTER.size else b""
        if len(foot) < _FOOTER.size or foot[-8:] != MAGIC:
            raise ValueError("no file of token ids, or one that was not written to its end")
        n, docs, self.n_ids, at, crc, _ = _FOOTER.unpack(foot)
        index = file.read_at(size - _FOOTER.size - at, at)
        if zlib.crc32(index) != crc:
            raise ValueError("the index of a file of token ids is damaged")
        found, place = [], 0
        for kind, k in (("<u8", n + 1), ("<u4", n), ("<u2", n), ("u1", n), ("<i8", docs), ("<u8", docs), ("u1", docs)):
            found.append(np.frombuffer(index, kind, k, place))
            place += np.dtype(kind).itemsize * k
        self.starts, self.minima, self.rests, self.widths, self.doc_ids, counts, nulls = found
        self.starts, self.widths, self.counts, self.nulls = self.starts.astype(np.int64), self.widths.astype(np.int64), counts.astype(np.int64), nulls.astype(bool)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start up to stop of the file."""
        stop = min(stop, self.n_ids)
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // VALUES, -(-stop // VALUES)
        base = int(self.starts[a])
        data = self.file.read_at(int(self.starts[b]) - base, base)
        got = decode_blocks(data, self.starts[a:b] - base, self.minima[a:b], self.widths[a:b], self.rests[a:b])
        return got[start - a * VALUES : stop - a * VALUES]

    def spans(self, ids: int = 1 << 22) -> Iterator[np.ndarray]:
        """All ids, in stretches of about so many."""
        step = max(VALUES, ids // VALUES * VALUES)
        for at in range(0, self.n_ids, step):
            yield self.ids(at, at + step)
