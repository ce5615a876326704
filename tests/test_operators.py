import random

import pytest
from pyspark.sql import functions as F

from lexirank.functions import scalars as S
from lexirank.operators import audit, compare, dedup, distribution, metrics, retry, review, scoring, upload
from lexirank.schemas import MissingColumns, level_column


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def levels(*xs):
    return [F.lit(x).cast("int") for x in xs]


@pytest.mark.parametrize("given,want", [((2, 3), 2), ((3, 4), 4), ((), 4), ((5,), 5), ((1, 2, 5), 2), ((None, 4, 5), 4)])
def test_median(spark, given, want):
    assert value(spark, S.median_level(*levels(*given, *[None] * (3 - len(given))))) == want


@pytest.mark.parametrize("given,want", [((1, 5, 5), 1), ((2, 4, 4), 2), ((3, 3, 5), 5), ((2, 2, 5), 2), ((4, 4, 4), 4)])
def test_extremes(spark, given, want):
    assert value(spark, S.merge_any_extremes(S.median_level(*levels(*given)), *levels(*given))) == want


def test_single_unsure_label_has_a_reason_but_is_no_outlier(spark):
    base = spark.createDataFrame([(1, "om", "N"), (1, "om", "N"), (2, "casă", "N")], "word_id long, word string, type string")
    run = spark.createDataFrame([(1, 3, 0.2), (9, 1, 0.9)], "word_id long, rarity_level int, confidence double")
    rows = compare.compare_runs(base, run, run.where("false")).orderBy("word_id").collect()
    assert [(r.word_id, r.final_level, r.is_outlier, r.reason) for r in rows] == [(1, 3, False, "low_confidence<0.55")] * 2 + [(2, 4, False, "")]
    with pytest.raises(ValueError):
        compare.compare_runs(base, run, run, strategy="mean")


def test_last_and_first_win_and_rewrites_do_not_shrink(spark):
    df = spark.createDataFrame([(1, 3, 0.3, 1), (1, 1, 0.9, 2)], "word_id long, rarity_level int, confidence double, seq long")
    assert dedup.last_wins(df, "word_id", "seq").first().rarity_level == 1
    assert dedup.first_wins(df, "word_id", "seq").first().rarity_level == 3
    with pytest.raises(ValueError):
        doubled = df.select("word_id", "rarity_level")
        dedup.guarded_rewrite(doubled, doubled.limit(0))


def test_level_columns(spark):
    df = spark.createDataFrame([(1, 5, 1)], "word_id long, rarity_level int, final_level int")
    assert level_column(df) == "final_level" and level_column(df, "rarity_level") == "rarity_level"
    with pytest.raises(MissingColumns):
        level_column(df.select("word_id"))


def test_distribution(spark):
    df = spark.createDataFrame([("1",), (" 2 ",), ("5",)], "l string")
    assert [(r.level, r.n) for r in distribution.rarity_distribution(df, "l").collect()] == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 1)]
    assert {r.pct for r in distribution.rarity_distribution(df.limit(0), "l").collect()} == {0.0}
    with pytest.raises(Exception, match="not a level"):
        distribution.rarity_distribution(spark.createDataFrame([("0",)], "l string"), "l").collect()


def test_audit_passes_and_fails(spark):
    schema = "word_id long, word string, final_level int"
    cand = spark.createDataFrame([(1, "Om ", 1), (2, "casă", 1), (3, "rarissim", 5)], schema)
    ref = spark.createDataFrame([(1, "om", 1), (2, "casă", 2), (3, "rarissim", 5)], schema)
    anchors = spark.createDataFrame([("om",), ("casă",)], "anchor string")
    got = audit.quality_audit(cand, "final_level", ref, None, anchors, min_jaccard=0.1, min_precision=0.4, min_recall=0.4).first()
    assert (got.l1_jaccard, got.anchor_precision, got.anchor_recall, got.passed) == (0.5, 1.0, 1.0, True)
    bad = audit.quality_audit(cand, "final_level", cand, None, spark.createDataFrame([("uzual",)], "anchor string"), min_precision=0.9).first()
    assert (bad.l1_jaccard, bad.anchor_precision, bad.passed) == (1.0, 0.0, False)
    assert audit.quality_audit(cand, "final_level").first().passed


def test_review(spark):
    run = spark.createDataFrame([(10, 1, 0.9), (11, 1, 0.2), (12, 4, 0.5)], "word_id long, rarity_level int, confidence double")
    items = review.review_items(run, "rarity_level", review.parse_only_levels("1"))
    assert [r.word_id for r in review.review_queue(items, spark.createDataFrame([], "word_id long, label string")).collect()] == [11, 10]
    items = spark.createDataFrame([(i, 1, 0.5) for i in (1, 2, 3)], "word_id long, predicted_level int, confidence double")
    labels = spark.createDataFrame([(1, 1, "1"), (2, 1, "undecided")], "word_id long, predicted_level int, label string")
    assert [r.word_id for r in review.review_queue(items, labels).collect()] == [3]
    assert [r.word_id for r in review.review_queue(items, labels, include_undecided=True).collect()] == [2, 3]
    stats = review.review_stats(spark.createDataFrame([(1, 1, "1"), (2, 1, "2"), (3, 1, "unknown_4_5"), (4, 1, "undecided"), (5, 2, "1")], labels.schema)).first()
    assert (stats.reviewed, stats.accepted, round(stats.precision, 6)) == (3, 1, 0.333333)
    with pytest.raises(ValueError):
        review.parse_only_levels("0,x")


def test_retry_keeps_repetitions(spark):
    lines = spark.createDataFrame([('{"word_id": 2}',), ('{"word_id": "4"}',), ('{"word_id": 2}',), ('{"word_id": "bad"}',), ("{",), ("",)], "value string")
    base = spark.createDataFrame([(1, "unu"), (2, "doi"), (2, "doi"), (4, "patru")], "word_id long, word string")
    assert sorted(r.word_id for r in retry.retry_input(base, retry.failed_ids(lines)).collect()) == [2, 2, 4]


def test_upload(spark):
    final = spark.createDataFrame([(1, 2), (7, 3)], "word_id long, level int")
    db = spark.createDataFrame([(1, None), (2, 5)], "word_id long, rarity_level int")
    rows = {r.word_id: (r.previous_level, r.new_level, r.source) for r in upload.upload_report(final, db).collect()}
    assert rows == {1: (None, 2, "final_csv"), 7: (None, None, "missing_db_word")}
    full = {r.word_id: (r.new_level, r.source) for r in upload.upload_report(final, db, "full-fallback").collect()}
    assert full == {1: (2, "final_csv"), 2: (4, "fallback_4")}
    marked = spark.createDataFrame([("1", "old"), ("x", "old"), ("3", "old")], "word_id string, upload_status string")
    got = upload.mark_uploaded(marked, upload.upload_status(final, db), uploaded_at=F.lit("t"), batch_id="b").collect()
    assert {r.word_id: (r.upload_status, r.uploaded_level) for r in got} == {"1": ("uploaded", "2"), "x": ("old", ""), "3": ("old", "")}


def test_adaptive_sizes(spark):
    df = spark.createDataFrame([(1, i, 0.0) for i in range(4)] + [(1, 4 + i, 1.0) for i in range(20)], "k int, i int, r double")
    sizes = [r["size"] for r in metrics.batch_sizes(df, "k", "i", "r", 50).orderBy("i").collect()]
    assert sizes[:4] == [33, 22, 14, 9] and sizes[-1] == 50 and min(sizes) >= 3
    with pytest.raises(ValueError):
        metrics.batch_sizes(df, "k", "i", "r", 2)


def test_resilient_scoring(spark):
    import pandas as pd

    calls = []

    def scorer(batch):
        calls.append(len(batch))
        if len(batch) > 2:
            raise ValueError("truncated")
        known = batch[batch.word_id != 5]
        return pd.DataFrame({"word_id": known.word_id, "rarity_level": 3, "tag": "t", "confidence": 0.5})

    batch = pd.DataFrame({"word_id": [1, 2, 3, 5], "word": list("abcd"), "type": "N"})
    got = scoring.resilient(scorer, batch, scoring.Retry(attempts=2))
    assert dict(zip(got.word_id, got.rarity_level.isna())) == {1: False, 2: False, 3: False, 5: True}

    def down(batch):
        raise ConnectionError("connection refused")

    with pytest.raises(scoring.Unreachable):
        scoring.resilient(down, batch)
    with pytest.raises(ValueError):
        scoring.score_words(spark.createDataFrame([(1, "a", "N")], "word_id long, word string, type string"), scorer, batch_size=4)


def test_folding(spark):
    assert value(spark, S.normalize(F.lit("ȘȚĂâîşţé"))) == "staaisté"
    assert value(spark, S.matches(F.lit("țară"), F.lit("tara"))) and not value(spark, S.matches(F.lit("casa"), F.lit("padure")))
    assert value(spark, S.confidence(F.lit("NaN"))) == 0.5 and value(spark, S.confidence(F.lit("85"))) == 0.85


def test_adaptive_sizes_in_slices_are_those_of_a_loop(spark):
    """Keys of many lengths, one of them over many slices, with gaps in their order; a null key is a key."""
    rng = random.Random(3)
    rows, want = [], []
    for key, n in ((1, 3000), (2, 1), (3, 11), (None, 250)):
        size, last, at = 50, [], 0
        for i in range(n):
            at += rng.choice([1, 1, 1, 7])
            ratio = rng.choice([0.1, 0.95, 1.0, 1.0]) if i // 40 % 2 else rng.choice([0.2, 0.3, 1.0])
            rows.append((key, at, ratio))
            last = [*last[-9:], ratio >= 0.9]
            rate = sum(last) / len(last)
            size = max(3, size * 2 // 3) if rate < 0.5 else min(50, size * 3 // 2) if rate > 0.9 else size
            want.append((key, i, size))
    frame = spark.createDataFrame(rows, "k int, o long, r double").repartition(5)
    for slice_rows in (1, 16, 500, None):
        got = [tuple(r) for r in metrics.batch_sizes(frame, "k", "o", "r", 50, slice_rows=slice_rows).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), slice_rows


def test_a_key_of_very_many_outcomes_is_split(spark):
    frame = spark.range(100_000).selectExpr("1 as k", "id as o", "cast(pmod(hash(id), 3) > 0 as double) as r")
    assert metrics.batch_sizes(frame, "k", "o", "r", 50).agg(F.count("*"), F.max("i")).first() == (100_000, 99_999)
