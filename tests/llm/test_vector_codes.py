import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexirank.llm.kdtree import assign, build, squared
from lexirank.llm.oracles import OP12
from lexirank.llm.vector_codes import codebooks_sha256, fit_and_code, with_label_errors


def plainly(points, entries):
    d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1)


@given(st.integers(1, 300), st.integers(1, 40), st.integers(1, 5), st.sampled_from([2, 9, 1000, 1 << 28]), st.integers(0, 2**31))
@settings(max_examples=120, deadline=None)
def test_a_tree_gives_the_nearest_entry_and_ties_the_lower(n, k, width, size, seed):
    """Small ranges make ties and repeated vectors; the largest one needs whole numbers of 64 bits."""
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-size, size + 1, (n, width)), rng.integers(-size, size + 1, (k, width))
    tree = build(points, 8)
    assert sorted(tree.order.tolist()) == list(range(n)) and (tree.points == points[tree.order]).all()
    found = assign(tree, entries)
    want = plainly(points, entries)[tree.order]
    assert (found.nearest == want).all()
    sums = np.zeros_like(entries)
    np.add.at(sums, want, tree.points)
    assert (found.sums == sums).all() and (found.counts == np.bincount(want, minlength=k)).all()


def test_boxes_spare_most_comparisons_in_clusters():
    rng = np.random.default_rng(3)
    centres = rng.integers(-2000, 2000, (64, 8))
    points = (centres[rng.integers(0, 64, 8000)] + rng.integers(-20, 21, (8000, 8))).astype(np.int64)
    found = assign(build(points), centres)
    assert (found.nearest == plainly(points, centres)[build(points).order]).all()
    assert found.compared < 0.02 * len(points) * len(centres)


def test_copies_of_one_vector_go_at_once():
    points = np.tile(np.array([[3, 4, 5]]), (5000, 1))
    tree = build(points)
    found = assign(tree, np.array([[9, 9, 9], [3, 4, 5], [3, 4, 5]]))
    assert len(tree.first) == 1 and found.compared == 0 and found.counts.tolist() == [0, 5000, 0]


def reference(rows):
    """Codes, errors and codebooks of (vec_id, vector, label) rows, one loop after the other."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 4
    parts = [np.array([v[p * w : (p + 1) * w] for _, v, _ in kept]) for p in range(4)]
    books = [x[:256].copy() for x in parts]
    for _ in range(4):
        for x, book in zip(parts, books):
            near = plainly(x, book)
            for e in set(near.tolist()):
                own = x[near == e]
                book[e] = own.sum(axis=0) // len(own)
    near = [plainly(x, b) for x, b in zip(parts, books)]
    errors = sum(squared(x, b[n]) for x, b, n in zip(parts, books, near))
    return [(i, bytes(int(n[k]) for n in near).hex(), int(errors[k]), lab) for k, (i, _, lab) in enumerate(kept)], books


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).round(2)], int(i) % 5 if i % 7 else None) for i in range(400)]
    rows += [(3, rows[3][1], 3), (3, rows[9][1], 1), (500, None, 1), (501, [0.1, None] * 4, 1), (502, [float("nan")] + [0.0] * 7, 1), (503, [float("-inf")] * 8, 2), (None, rows[0][1], None)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)


def test_codes_against_plain_loops(spark, table):
    rows, frame = table
    want, books = reference(rows)
    coded, codebooks = fit_and_code(frame.selectExpr("*", "'x' as code", "1 as part", "2 as error"))
    got = sorted((tuple(r) for r in coded.select("vec_id", "code", "error", "label").collect()), key=str)
    assert got == sorted(((i, c, e, None if lab is None else str(lab)) for i, c, e, lab in want), key=str)
    text = ",".join(str(x) for b in books for row in b.tolist() for x in row)
    assert codebooks_sha256(codebooks) == hashlib.sha256(text.encode()).hexdigest()
    by_label = {}
    for _, _, e, lab in want:
        by_label[lab] = by_label.get(lab, 0) + e
    for r in with_label_errors(coded).collect():
        assert r.label_error == by_label[None if r.label is None else int(r.label)]


def test_sql_agrees(spark, table, tmp_path):
    rows, frame = table
    frame = frame.filter("vec_id is not null and not (vec_id = 3)")
    frame.coalesce(1).write.parquet(str(tmp_path / "embeddings"))
    base = duckdb.connect()
    base.execute(f"create view embeddings as select * from '{tmp_path}/embeddings/*.parquet'")
    coded, books = fit_and_code(frame)
    got = sorted((r.vec_id, r.code, r.error, r.label_error, codebooks_sha256(books)) for r in with_label_errors(coded).collect())
    assert got == sorted(base.execute(OP12).fetchall())


def test_few_odd_and_no_vectors(spark, table):
    _, frame = table
    few, books = fit_and_code(frame.filter("vec_id in (1, 2)"))
    assert [(r.vec_id, r.code, r.error) for r in few.orderBy("vec_id").collect()] == [(1, "00000000", 0), (2, "01010101", 0)]
    assert [len(b) for b in books] == [2] * 4
    none, books = fit_and_code(frame.limit(0))
    assert none.count() == 0 and books == [] and with_label_errors(none).count() == 0
    mixed = spark.createDataFrame([(1, [0.5] * 8), (2, [0.5] * 4), (3, []), (4, [0.25] * 8)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.code, r.error) for r in fit_and_code(mixed)[0].collect()}
    assert got == {1: ("00000000", 0), 2: (None, None), 3: (None, None), 4: ("01010101", 0)}
    uneven = spark.createDataFrame([(1, [0.5] * 6)], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.code) for r in fit_and_code(uneven)[0].collect()] == [(1, None)]
    with pytest.raises(Exception, match="beyond"):
        fit_and_code(spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>"))


def test_equal_vectors_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [0.5] * 8 if i % 3 == 0 else [float(x) for x in rng.normal(0, 0.3, 8)], 1) for i in range(900)]
    coded, _ = fit_and_code(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4))
    want, _ = reference(rows)
    assert sorted((r.vec_id, r.code, r.error) for r in coded.collect()) == sorted(w[:3] for w in want)
