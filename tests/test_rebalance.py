import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexirank.operators import rebalance as R
from lexirank.plans import chain
from lexirank.sources.scratch import written
from lexirank.transitions import parse_transition, parse_transitions


def plan_batches(counts, batch_size, ratio):
    """Batch after batch, as a plain loop makes them."""
    levels = sorted(counts)
    left, taken = [counts[x] for x in levels], [0] * len(levels)
    rows, done, batch = [], 0, 0
    while sum(left):
        size = min(batch_size, sum(left))
        shares = R.within_supply(R.largest_remainder(size, [counts[x] for x in levels]) if len(levels) > 1 else [size], left)
        target = round((done + size) * ratio) - round(done * ratio)
        for i, level in enumerate(levels):
            if shares[i]:
                rows.append({"batch": batch, "level": level, "rank_from": taken[i] + 1, "rank_to": taken[i] + shares[i], "size": size, "target": target})
            taken[i] += shares[i]
            left[i] -= shares[i]
        done += size
        batch += 1
    return rows


@given(st.lists(st.integers(0, 400), min_size=1, max_size=4), st.integers(1, 90))
@settings(max_examples=200, deadline=None)
def test_phases_are_the_loops_batches(counts, size):
    by_level = {i + 1: n for i, n in enumerate(counts)}
    phases = R.plan_phases(by_level, size)
    got = []
    for p in phases:
        for k in range(p["batches"]):
            for level, share in p["shares"].items():
                if share:
                    got.append((p["batch"] + k, level, p["taken"][level] + share * k + 1, p["taken"][level] + share * (k + 1), p["size"], p["done"] + k * p["size"]))
    want = [(r["batch"], r["level"], r["rank_from"], r["rank_to"], r["size"], r["batch"] * size) for r in plan_batches(by_level, size, 0.5)]
    assert got == want
    if len(counts) <= 2:
        assert len(phases) <= 5


@given(st.lists(st.integers(0, 400), min_size=1, max_size=2), st.integers(1, 90), st.floats(0.01, 1))
@settings(max_examples=200, deadline=None)
def test_plan_takes_every_word_once_and_meets_the_total(counts, size, ratio):
    by_level = {i + 2: n for i, n in enumerate(counts)}
    rows = plan_batches(by_level, size, ratio)
    for level, n in by_level.items():
        ranks = [r for row in rows if row["level"] == level for r in range(row["rank_from"], row["rank_to"] + 1)]
        assert ranks == list(range(1, n + 1))
    batches = {row["batch"]: row for row in rows}
    assert all(sum(r["rank_to"] - r["rank_from"] + 1 for r in rows if r["batch"] == b) == row["size"] <= size for b, row in batches.items())
    assert sum(row["target"] for row in batches.values()) == round(sum(counts) * ratio)
    assert all(0 <= row["target"] <= row["size"] for row in batches.values())


def test_shares():
    assert R.largest_remainder(10, [1, 1, 1]) == [4, 3, 3]
    assert R.largest_remainder(5, [300, 100]) == [4, 1]
    assert R.within_supply([4, 1], [2, 9]) == [2, 3]
    assert R.within_supply([3, 3], [1, 1]) == [1, 1]


def words(spark, n, seed=3):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, rng.randint(1, 5), float(rng.randint(0, 50))) for i in range(n)], "word_id long, level int, score double")


@pytest.mark.parametrize("text", ["2-3:3", "2-3:2", "4:4", "2:1"])
def test_transition_against_a_plain_loop(spark, text):
    t, size, ratio = parse_transition(text), 40, 0.37
    df = words(spark, 700)
    got = {r.word_id: (r.level, r.batch) for r in R.apply_transition(df.withColumn("processed", F.lit(False)), t, ratio=ratio, batch_size=size).collect()}
    rows = df.collect()
    key = lambda r: ((r.word_id % 2**32) * 2654435761 % 2**32, r.word_id)
    queues = {level: sorted((r for r in rows if r.level == level), key=key) for level in t.sources}
    want = {r.word_id: (r.level, None) for r in rows}
    for number, plan in enumerate(_batches(plan_batches({k: len(v) for k, v in queues.items()}, size, ratio))):
        batch = [r for p in plan for r in queues[p["level"]][p["rank_from"] - 1 : p["rank_to"]]]
        target = plan[0]["target"]
        common = target if t.to == t.common else len(batch) - target
        for i, r in enumerate(sorted(batch, key=lambda r: (r.score, r.word_id))):
            want[r.word_id] = (t.common if i < common else t.rare, number)
    assert got == want


def _batches(plan):
    out = {}
    for row in plan:
        out.setdefault(row["batch"], []).append(row)
    return [out[k] for k in sorted(out)]


def test_slices_rank_as_one(spark, monkeypatch):
    df = words(spark, 900).withColumn("processed", F.lit(False))
    whole = {r.word_id: r._rank for r in R._ranked(df, 900, 0).collect()}
    monkeypatch.setattr(R, "SLICE_ROWS", 100)
    assert {r.word_id: r._rank for r in R._ranked(df, 900, 0).collect()} == whole


def test_words_are_taken_once_and_none_is_lost(spark):
    done = R.rebalance(words(spark, 600), parse_transitions("2:1,3:2,4:3"), batch_size=50).collect()
    assert len(done) == 600
    before = {r.word_id: r.level for r in words(spark, 600).collect()}
    for r in done:
        assert r.processed == (before[r.word_id] in (2, 3, 4))
        assert r.level in ({before[r.word_id], before[r.word_id] - 1} if r.processed else {before[r.word_id]})


def test_pick_replaces_the_score(spark):
    df = words(spark, 200).withColumn("processed", F.lit(False))
    pick = lambda rows: rows.withColumn("is_common", F.col("word_id") % 2 == 0)
    after = R.apply_transition(df, parse_transition("4:4"), ratio=0.5, batch_size=20, pick=pick)
    assert {(r.level, r.word_id % 2) for r in after.where("batch is not null").collect()} == {(4, 0), (5, 1)}


def test_no_eligible_words(spark):
    df = spark.createDataFrame([(1, 1, 0.5)], "word_id long, level int, score double").withColumn("processed", F.lit(False))
    assert R.apply_transition(df, parse_transition("3:2")).first().level == 1


def test_replay_takes_the_first_switch_of_known_words_under_its_input(spark):
    df = spark.createDataFrame([(1, 4), (2, 4), (3, 4)], "word_id long, level int")
    rows = spark.createDataFrame(
        [("t1", "4:4", "f", 0, [1, 2, 99], [(1, 5, "a")]), ("t2", "4:4", "f", 1, [1], [(1, 3, "b")]), ("t0", "4:4", "g", 0, [3], [(3, 5, "c")])],
        "timestamp string, transition string, fingerprint string, batch long, processed_word_ids array<long>, switched array<struct<word_id:long,new_level:int,rule:string>>",
    )
    got = {r.word_id: (r.level, r.processed) for r in R.replay_checkpoint(df, rows, "f").collect()}
    assert got == {1: (5, True), 2: (4, True), 3: (4, False)}


def test_chain_targets_and_ratios():
    assert chain.chain_targets(77698)[4] == 77698 - 55000
    with pytest.raises(ValueError):
        chain.chain_targets(100)
    t = parse_transition("1-2:1")
    assert chain.step_ratio(t, {1: 10, 2: 30}, {1: 20}) == 0.5
    for counts, target in (({1: 1}, 1), ({1: 10, 2: 10}, 20), ({1: 1000, 2: 1000}, 1)):
        with pytest.raises(ValueError):
            chain.step_ratio(t, counts, {1: target})


def test_progress_tells_the_distribution_after_each_batch(spark, monkeypatch):
    monkeypatch.setattr(R, "SUMMED_BATCHES", 3)
    df = words(spark, 700).withColumn("word", F.concat(F.lit("w"), "word_id"))
    t = parse_transition("2-3:3")
    after = R.apply_transition(df.withColumn("processed", F.lit(False)), t, ratio=0.37, batch_size=40).cache()
    level = {r.word_id: r.level for r in df.collect()}
    by_batch = {}
    for r in after.where("batch is not null").collect():
        by_batch.setdefault(r.batch, []).append(r)
    left = sum(map(len, by_batch.values()))
    for p in R.progress_rows(after, t).orderBy("batch").collect():
        rows = sorted(by_batch[p.batch], key=lambda r: r.word_id)
        level.update({r.word_id: r.level for r in rows})
        left -= len(rows)
        assert p.distribution == {str(x): sum(v == x for v in level.values()) for x in range(1, 6)}
        assert (p.remaining, p.size, p.target, p.transition) == (left, len(rows), rows[0].target, "2-3:3")
        assert p.selected_word_ids == [r.word_id for r in rows] and p.selected_words == [f"w{r.word_id}" for r in rows]
        assert p.picked_target_ids == [r.word_id for r in rows if not r.is_common] and p.picked_words == [f"w{r.word_id}" for r in rows if not r.is_common]
        assert p.switched == sum(r.level != r.previous_level for r in rows)


def test_progress_of_one_batch(spark):
    """Batch 1, 2: picked 2 of 4:4, 8 remaining; and a rare target: of 1, 2, 3 with 1 and 3 common, 2 is picked of 2-3:3."""
    schema = "word_id long, word string, level int, previous_level int, batch long, target int, is_common boolean"
    rows = [(1, "a", 5, 4, 0, 1, False), (2, "b", 4, 4, 0, 1, True)] + [(i, "x", 4, 4, 1, 4, True) for i in range(3, 11)]
    first = R.progress_rows(spark.createDataFrame(rows, schema), parse_transition("4:4")).orderBy("batch").first()
    assert first.picked_target_ids == [2] and first.remaining == 8 and first.picked_words == ["b"]
    rows = [(1, "a", 2, 2, 0, 1, True), (2, "b", 3, 2, 0, 1, False), (3, "c", 2, 3, 0, 1, True)]
    assert R.progress_rows(spark.createDataFrame(rows, schema), parse_transition("2-3:3")).first().picked_target_ids == [2]


def test_transitions_of_one_pass_are_those_of_several(spark):
    """All at once, and one after the other on what the earlier ones left; one plan ranks the words once and joins nothing by id."""
    start = words(spark, 700).withColumn("processed", F.expr("word_id % 11 = 0"))
    found = parse_transitions("2:1,3:2,4-5:5")
    one = R.rebalance(start, found, batch_size=40, ratio=0.3, seed=5)
    state, taken = start, {}
    for t in found:
        after = written(R.apply_transition(state, t, batch_size=40, ratio=0.3, seed=5))
        taken |= {r.word_id: (r.level, r.batch, r.target, r.is_common, r.previous_level, r.rule) for r in after.where("batch is not null").collect()}
        state = after.select(*start.columns)
    got = {r.word_id: (r.level, r.batch, r.target, r.is_common, r.previous_level, r.rule) for r in one.collect()}
    assert {i: v for i, v in got.items() if v[1] is not None} == taken and len(got) == 700
    assert {r.word_id: r.level for r in state.collect()} == {i: v[0] for i, v in got.items()}
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and "Join" not in plan
