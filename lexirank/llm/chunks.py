"""Distinct chunks of texts: what a tokenizer does with a chunk is worked out once for all its places in a block.

A chunk is what lies between spaces. Splitting and telling chunks apart is done on whole Arrow columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is cut at spaces.
BLOCK = 4 << 20


def pieces(texts: list[str | None], size: int = BLOCK) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """Blocks of whole texts of about `size` characters: numbers of the texts, the texts, and whether each ends there.

    A text of more than `size` is cut at spaces, which the parts then lack; null is as empty.
    """
    numbers: list[int] = []
    held: list[str] = []
    last: list[bool] = []
    room = size
    for i, text in enumerate(texts):
        text, at = text or "", 0
        while True:
            cut = len(text)
            if cut - at > size:
                cut = text.rfind(" ", at, at + size)
                cut = cut if cut >= 0 else text.find(" ", at + size)
                cut = cut if cut >= 0 else len(text)
            numbers.append(i)
            held.append(text[at:cut] if at or cut < len(text) else text)
            last.append(cut == len(text))
            room -= cut - at + 1
            if room <= 0:
                yield numbers, held, last
                numbers, held, last, room = [], [], [], size
            if cut == len(text):
                break
            at = cut + 1
    if numbers:
        yield numbers, held, last


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of `length` each, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Remembered:
    """Slots of chunks seen lately. `work` gets new ones, in order, whose slots follow those there are; `forget` is told when all go."""

    def __init__(self, work: Callable[[list[str]], None], forget: Callable[[], None], limit: int) -> None:
        self.work, self.forget, self.limit = work, forget, limit
        self.known = pa.array([], pa.string())

    def slots(self, chunks: pa.Array) -> np.ndarray:
        coded = pc.dictionary_encode(chunks)
        if len(self.known) > self.limit:
            self.known = self.known.slice(0, 0)
            self.forget()
        found = pc.index_in(coded.dictionary, value_set=self.known)
        new = coded.dictionary.filter(pc.is_null(found))
        slot = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            slot[slot < 0] = np.arange(len(new)) + len(self.known)
            self.work(new.to_pylist())
            self.known = pa.concat_arrays([self.known, new])
        return slot[coded.indices.to_numpy(zero_copy_only=False)]
