import threading

import pytest
from pyspark.sql import functions as F

from lexirank.sources.versions import Conflict, VersionedTable
from lexirank.streaming.run_log import merge_batch


def rows(spark, ids, level, seq):
    return spark.createDataFrame([(i, level, seq) for i in ids], "word_id long, rarity_level int, seq long")


def levels(frame):
    return {r.word_id: r.rarity_level for r in frame.collect()}


def test_versions_are_pinned_and_last_wins(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), range_rows=10)
    assert table.manifest() is None and table.versions() == []
    with pytest.raises(ValueError, match="no table"):
        table.read()
    table.merge(rows(spark, [*range(60), None], 1, 1))
    pinned = table.read()
    assert len(table.manifest().ranges) >= 4 and [r.rows for r in table.manifest().ranges if r.rows] and pinned.count() == 61
    table.merge(rows(spark, [5, 5, None, 100], 2, 3).unionByName(rows(spark, [5, 7], 3, 0)))
    assert levels(table.read()) == {**{i: 1 for i in range(60)}, 5: 2, None: 2, 100: 2}
    assert levels(pinned) == {i: 1 for i in [*range(60), None]} == levels(table.read(0))
    assert levels(table.read(low=58, high=100)) == {58: 1, 59: 1, 100: 2}
    assert table.versions() == [0, 1] and sum(r.rows for r in table.manifest().ranges) == 62


def test_a_merge_rewrites_what_it_touches(spark, tmp_path):
    """A batch of neighbouring ids into two million rows writes under 5 % of the files; ids all over write all."""
    table = VersionedTable(spark, str(tmp_path / "t"), range_rows=40_000)
    table.merge(spark.range(2_000_000).select(F.col("id").alias("word_id"), F.lit(1).alias("rarity_level"), F.lit(1).cast("long").alias("seq")))
    before = {f for r in table.manifest().ranges for f in r.files}
    assert len(before) >= 45
    table.merge(rows(spark, range(1_234_000, 1_235_000), 4, 2))
    after = {f for r in table.manifest().ranges for f in r.files}
    assert len(after - before) < 0.05 * len(before) and len(before - after) < 0.05 * len(before)
    assert table.read().groupBy("rarity_level").count().orderBy("rarity_level").collect() == [(1, 1_999_000), (4, 1000)]
    read = table.read(low=1_234_000, high=1_234_999)
    assert read.count() == 1000 and len(read.inputFiles()) <= 2


def test_a_reader_never_fails_while_merges_run(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), range_rows=20)
    table.merge(rows(spark, range(40), 1, 0))
    stop, wrong, counts = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                counts.append(VersionedTable(spark, table.path).read().count())
            except Exception as x:  # noqa: BLE001
                wrong.append(x)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(12):
        table.merge(rows(spark, [n, 40 + n], 2, n + 1))
    stop.set()
    reader.join()
    assert not wrong and counts == sorted(counts) and len(counts) > 3


def test_of_two_writers_of_a_range_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = VersionedTable(spark, path, 10), VersionedTable(spark, path, 10)
    first.merge(rows(spark, range(40), 1, 0))
    publish = first._publish

    def late(manifest):
        """Another writer comes in between reading and publishing."""
        first._publish = publish
        second.merge(between)
        return publish(manifest)

    between, first._publish = rows(spark, [3], 5, 9), late
    with pytest.raises(Conflict, match="changed keys"):
        first.merge(rows(spark, [2], 4, 9))
    between, first._publish = rows(spark, [4], 5, 9), late
    first.merge(rows(spark, [39], 4, 9))  # another range: both stand
    got = levels(first.read())
    assert (got[2], got[3], got[4], got[39]) == (1, 5, 5, 4)
    files = {f for r in first.manifest().ranges for f in r.files}
    assert first.vacuum(keep=1) > 0 and {f for r in first.manifest().ranges for f in r.files} == files
    assert levels(first.read()) == got and len(first.versions()) == 1


def test_a_batch_that_comes_twice_is_passed_over(spark, tmp_path):
    table = str(tmp_path / "t")
    row = lambda i, level, seq: (i, "w", "N", level, "t", 0.5, "x", "m", "r", seq)
    schema = "word_id long, word string, type string, rarity_level int, tag string, confidence double, scored_at string, model string, run_slug string, seq long"
    merge_batch(spark.createDataFrame([row(1, 1, 1), row(2, 1, 1)], schema), table, 0)
    merge_batch(spark.createDataFrame([row(1, 4, 5)], schema), table, 1)
    merge_batch(spark.createDataFrame([row(1, 2, 9)], schema), table, 1)
    assert levels(VersionedTable(spark, table).read()) == {1: 4, 2: 1}
    assert len(VersionedTable(spark, table).versions()) == 2


def test_keys_are_whole_numbers(spark, tmp_path):
    with pytest.raises(ValueError, match="whole number"):
        VersionedTable(spark, str(tmp_path / "t")).merge(spark.createDataFrame([("a", 1)], "word_id string, seq int"))
    empty = VersionedTable(spark, str(tmp_path / "e"))
    empty.merge(rows(spark, [], 1, 1))
    assert empty.read().count() == 0
