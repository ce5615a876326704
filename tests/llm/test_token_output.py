import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexirank.llm.chunks import pieces
from lexirank.llm.idfile import VALUES, Reader, Writer, pack, unpack
from lexirank.llm.token_output import WordBpe, read_ids, write_ids
from lexirank.llm.warc import _file_system

from .conftest import LONG

PATH = public_tokenizers.path("word_bpe_49k.json")


class Bytes(io.BytesIO):
    def close(self):
        pass

    def size(self):
        return len(self.getvalue())

    def read_at(self, n, start):
        return self.getvalue()[start : start + n]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("width", [0, 1, 7, 13, 16, 31, 32])
def test_packed_words_round_trip(width):
    x = np.random.default_rng(width).integers(0, 2**width, (3, VALUES), dtype=np.uint64).astype(np.uint32)
    words = pack(x, width)
    assert words.shape == (3, 32 * width)
    assert (unpack(words, width) == x).all()


@given(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 2**32 - 1), st.integers(70, 90)), max_size=50), st.integers(1, 200), st.integers(0, 2**31))
@settings(max_examples=60, deadline=None)
def test_any_ids_come_back_and_any_range_of_them(some, times, seed):
    ids = np.array(some * times, np.uint32)
    out = Bytes()
    writer = Writer(out)
    cut = len(ids) // 3
    for part in (ids[:cut], ids[cut : cut + 1], ids[cut + 1 :]):
        writer.ids(part)
    writer.documents(np.array([5]), np.array([False]), np.array([len(ids)]))
    writer.close()
    reader = Reader(out)
    assert (np.concatenate([*reader.spans(VALUES), np.zeros(0, np.uint32)]) == ids).all()
    a, b = sorted(np.random.default_rng(seed).integers(0, len(ids) + 1, 2).tolist())
    assert (reader.ids(a, b) == ids[a:b]).all()


def test_outliers_are_exceptions_and_blocks_are_small():
    """Ids of 5 bits with a large one in each block take about 5 bits; all bits of the large one come back."""
    ids = np.random.default_rng(1).integers(1000, 1032, 40 * VALUES).astype(np.uint32)
    ids[::VALUES] = 4_000_000_000
    out = Bytes()
    writer = Writer(out)
    writer.ids(ids)
    writer.close()
    reader = Reader(out)
    assert set(reader.widths.tolist()) == {5} and set(reader.rests.tolist()) == {1} and set(reader.minima.tolist()) == {1000}
    assert (reader.ids(0, len(ids)) == ids).all()
    assert int(reader.starts[-1]) < len(ids) * 5.2 / 8


def test_a_damaged_or_unfinished_file_is_told():
    out = Bytes()
    writer = Writer(out)
    writer.ids(np.arange(3000, dtype=np.uint32))
    with pytest.raises(ValueError, match="end"):
        Reader(Bytes(out.getvalue()))
    writer.close()
    data = bytearray(out.getvalue())
    data[-60] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        Reader(Bytes(bytes(data)))


@given(st.lists(st.text(alphabet=" \n\t  ABé́İß日1.,!'sª\0", max_size=30), max_size=4))
@settings(max_examples=400, deadline=None)
def test_chunks_give_the_library_ids(texts):
    fast = WordBpe.__dict__.get("_test") or WordBpe(PATH)
    WordBpe._test = fast
    texts = [*texts, "don't <|endoftext|>x <|startoftext|> 1'll"]
    ids, counts = fast.encode(texts)
    want = [fast.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


def test_remembered_chunks_are_forgotten(library):
    fast = WordBpe(PATH)
    fast.remembered.limit = 5
    for k in range(4):
        texts = [f"alpha beta{k} gamma{k} delta", f"beta{k} x y z"]
        ids, _ = fast.encode(texts)
        assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def test_long_texts_are_cut_at_spaces():
    texts = ["a bc " * 30, None, "x" * 50, "", "y " * 20]
    blocks = list(pieces(texts, 16))
    found = [(n, t, e) for b in blocks for n, t, e in zip(*b)]
    for i, text in enumerate(texts):
        own = [(t, e) for n, t, e in found if n == i]
        assert " ".join(t for t, _ in own) == (text or "")
        assert [e for _, e in own] == [False] * (len(own) - 1) + [True]
    assert max(len(t) for _, t, _ in found) == 50


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def facts(rows, library):
    """What the files must say of (doc_id, text) rows, in order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_documents_come_back_from_the_files(spark, docs, empty, library, many_tasks):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    files = write_ids(docs, PATH, file_ids=50)
    got = sorted((tuple(r) for r in read_ids(files).collect()), key=lambda r: r[1])
    want = facts(rows, library)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    by_id = lambda rows, i: next(r for r in rows if r[0] == i)
    assert all(by_id(got, i) == by_id(want, i) for i in (2, 3, 4, 5, 6, 7, 8, 9))
    assert files.count() > 1
    assert read_ids(write_ids(empty, PATH)).count() == 0


def test_a_reader_finds_one_document_by_the_index(spark, docs, library):
    files = write_ids(docs.filter("doc_id = 6 or doc_id = 7"), PATH).collect()
    for f in files:
        fs, place = _file_system(f.path)
        with fs.open_input_file(place) as file:
            reader = Reader(file)
            for doc_id, end, n in zip(reader.doc_ids.tolist(), np.cumsum(reader.counts).tolist(), reader.counts.tolist()):
                text = LONG if doc_id == 6 else "one two"
                assert reader.ids(end - n, end).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_query_against_the_library(spark, library):
    from lexirank.llm.queries import op11_token_output

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in op11_token_output(spark, sf).orderBy("doc_id").collect()]
    assert got == facts(rows, library)


def test_one_id_of_a_third_of_the_rows_is_dealt_out(spark, many_tasks):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    files = write_ids(rows.repartition(8), PATH)
    assert files.agg(F.sum("n_docs")).first()[0] == 3000
    assert files.agg(F.max("n_docs")).first()[0] < 1500
    assert read_ids(files).filter("doc_id = 7").count() == 1001
