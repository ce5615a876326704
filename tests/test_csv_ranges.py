import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexirank.sources import csv_ranges, tables


def text_of(rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, quoting=quoting, lineterminator=end).writerows(rows)
    return out.getvalue()


class Local:
    """A file of bytes with read_at(), as those of pyarrow."""

    def __init__(self, data):
        self.data = data

    def read_at(self, n, start):
        return self.data[start : start + n]


CELL = st.text(alphabet='ab,"\n é', max_size=6)


@given(st.lists(st.tuples(CELL, CELL), max_size=12), st.integers(1, 40), st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), st.sampled_from(["\n", "\r\n"]), st.booleans())
@settings(max_examples=400, deadline=None)
def test_ranges_hold_every_record_once_and_in_order(rows, size, quoting, end, closed):
    rows = [("k", "v"), *[r for r in rows if r != ("", "")]]
    text = text_of(rows, quoting, end)
    data = (text if closed else text.removesuffix(end)).encode()
    inside, got, odd = [], [], 0
    for start in range(0, len(data), size):
        inside.append(odd % 2 == 1)
        odd += data[start : start + size].count(b'"')
    for k, start in enumerate(range(0, len(data), size)):
        found = csv_ranges.records_of(Local(data), len(data), start, min(start + size, len(data)), inside[k])
        got += [tuple(r.values()) for r in csv_ranges.parsed(found, ["a", "b"], "x").to_pylist()]
    assert got == rows


def write(path, rows, quoting=csv.QUOTE_MINIMAL):
    path.write_bytes(text_of(rows, quoting).encode())
    return str(path)


def in_order(frame):
    return [tuple(r)[:-1] for r in frame.orderBy(frame.columns[-1]).collect()]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_many_ranges_give_what_one_task_gives(spark, tmp_path, quoting):
    rng = random.Random(4)
    cell = lambda: "".join(rng.choice(['x', '"', "\n", ",", "ă", " "]) for _ in range(rng.randrange(30)))
    rows = [("word_id", "word", "note")] + [(str(i), f"w{cell()}", cell()) for i in range(3000)]
    path = write(tmp_path / "a.csv", rows, quoting)
    found = csv_ranges.read_ranges(spark, path, 4096)
    assert found.rdd.getNumPartitions() > 10
    assert in_order(found) == rows[1:]
    assert sorted(in_order(tables.read_whole(spark, path))) == sorted(rows[1:])
    folder = tmp_path / "b"
    folder.mkdir()
    for name, part in (("p1.csv", rows[:1000]), ("p0.csv", rows[:1] + rows[1000:]), ("_SUCCESS", []), (".crc", [("x",)])):
        write(folder / name, part, quoting)
    assert in_order(csv_ranges.read_ranges(spark, str(folder), 3000)) == rows[1000:] + rows[1:1000]


def test_a_cell_of_many_ranges_is_one_cell(spark, tmp_path):
    rows = [("a", "b"), ("1", 'line "one"\n' * 3000), ("2", "x")]
    assert in_order(csv_ranges.read_ranges(spark, write(tmp_path / "a.csv", rows), 1000)) == rows[1:]


def test_last_row_of_an_id_is_that_of_the_file(spark, tmp_path):
    """Thousands of rows of one id over many ranges: the last in the file counts."""
    rows = [("word_id", "word", "type", "final_level")] + [(str(i % 7), "two\nlines", "N", str(i % 5 + 1)) for i in range(5000)]
    path = write(tmp_path / "f.csv", rows)
    ranged = csv_ranges.read_ranges(spark, path, 2000).withColumnRenamed("_seq", "seq")
    last = {r.word_id: r.final_level for r in tables.last_wins(ranged, "word_id", "seq").collect()}
    assert last == {r[0]: r[3] for r in rows[1:]}
    assert {r.word_id: str(r.level) for r in tables.read_final_levels(spark, path).collect()} == {int(k): v for k, v in last.items()}


@pytest.mark.parametrize("body", ['1,a "quoted" word\n2,b\n', '1,"a"b\n2,c\n', '1,5" disk\n2,6" disk\n'])
def test_quotes_within_cells_are_left_to_one_task(spark, tmp_path, body):
    path = tmp_path / "q.csv"
    path.write_text("k,v\n" + body)
    assert csv_ranges.read_ranges(spark, str(path), 8) is None
    assert [r.k for r in tables.read_csv(spark, str(path)).collect()] == ["1", "2"]


def test_edges_of_files(spark, tmp_path):
    for name, data in (("bom", b"\xef\xbb\xbfk,v\n1,a\n"), ("blank", b"\n\r\nk,v\n\n1,a\n\n"), ("open", b"k,v\n1,a"), ("cr", b"k,v\r\n1,a\r\n"), ("quoted", b'"k","v"\n"1","a"')):
        path = tmp_path / name
        path.write_bytes(data)
        for size in (16, 1000) if name in ("bom", "blank") else (2, 5, 1000):
            rows = csv_ranges.read_ranges(spark, str(path), size)
            assert rows.columns == ["k", "v", "_seq"] and in_order(rows) == [("1", "a")], (name, size)
    only = tmp_path / "only"
    only.write_bytes(b"k,v\n")
    assert tables.read_csv(spark, str(only)).collect() == [] and tables.read_csv(spark, str(only)).columns == ["k", "v"]
    bad = tmp_path / "bytes"
    bad.write_bytes(b"k,v\n1,a\xff\n")
    assert [r.v for r in tables.read_csv(spark, str(bad)).collect()] == ["a�"]
    for name, row in (("long", b"1,a,x"), ("short", b"1")):
        (tmp_path / name).write_bytes(b"k,v\n2,b\n" + row + b"\n")
        with pytest.raises(Exception, match="does not fit"):
            csv_ranges.read_ranges(spark, str(tmp_path / name), 3).collect()


def test_packed_files_and_repeated_names_are_left_to_spark(spark, tmp_path):
    spark.createDataFrame([("1", "a")], "k string, v string").write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "z"))
    assert csv_ranges.read_ranges(spark, str(tmp_path / "z")) is None
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "z")).collect()] == [("1", "a")]
    assert csv_ranges.read_ranges(spark, write(tmp_path / "t.csv", [("k", "K"), ("1", "2")])) is None
