import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexirank.llm.packing import ByteBpe, best_fit_decreasing, pack

from .conftest import LONG, ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_is_what_a_plain_search_gives(lengths):
    at, offset, made = best_fit_decreasing(lengths, 64)
    open_, want = [], 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        fits = [c for c in open_ if c >= lengths[i]]
        if fits:
            open_.remove(min(fits))
            open_.append(min(fits) - lengths[i])
        else:
            want += 1
            open_.append(64 - lengths[i])
    assert made == want
    held = defaultdict(list)
    for i, n in enumerate(lengths):
        held[at[i]].append((offset[i], n))
    for parts in held.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 64


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@given(st.text(alphabet=" \n\t ab'sé日1.,!\0", max_size=40))
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_library_ids(text):
    fast = ByteBpe.__dict__.get("_test") or ByteBpe(PATH)
    ByteBpe._test = fast
    assert fast.encode(text) == fast._bytes(fast.library.encode(text, add_special_tokens=False).ids)


def test_every_id_once_in_gapless_windows(spark, docs, empty, library):
    pieces = pack(docs, PATH).collect()
    by_doc = defaultdict(list)
    windows = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length <= 4 * 2048
        by_doc[p.doc_id, p.doc_tokens].append(p)
        windows[p.sequence_id].append(p)
    for (doc, n), parts in by_doc.items():
        texts = [r[1] or "" for r in ROWS if r[0] == doc]
        ids = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        copies = sum(len(x) == n for x in ids)
        want = b"".join(i.to_bytes(4, "little") for i in next(x for x in ids if len(x) == n))
        assert sum(p.length for p in parts) == n * copies
        for p in parts:
            assert p.ids == want[4 * p.start : 4 * (p.start + p.length)] and zlib.crc32(p.ids) >= 0
    for parts in windows.values():
        end = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= 2048
    assert sum(n for _, n in {(p.start, p.length) for p in pieces if p.doc_id == 6}) == len(library.encode(LONG, add_special_tokens=False).ids) + 1
    assert pack(empty, PATH).count() == 0


def test_padding_is_little_however_the_input_is_split(spark):
    """Of 1,000 documents in one to eight tasks: windows are 98 % full at least."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for parts in (1, 8):
        rows = pack(docs.repartition(parts), PATH).select("sequence_id", "length").collect()
        full = defaultdict(int)
        for r in rows:
            full[r.sequence_id] += r.length
        assert sum(full.values()) / (2048 * len(full)) > 0.98, parts
