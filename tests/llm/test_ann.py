import numpy as np
import pytest

from lexirank.llm.ann import Index, nearest

SCHEMA = "vec_id long, embedding array<float>, rank int, row string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k=20):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = np.array(v, dtype=np.float32).astype(np.float64)
    out = {}
    for q in ok:
        if q % 20 == 0:
            scores = sorted(((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in scores]
    return out


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 70))
    index = Index().fit(x[:1000], 6)
    own, bits, length, correction = index.encode(x)
    for c in range(6):
        at = np.flatnonzero(own == c)
        q = rng.standard_normal((40, 70))
        estimate, bound = index.estimate(q, c, bits[at], length[at], correction[at])
        wrong = np.abs(estimate - q @ x[at].T) > bound
        assert wrong.mean() < 0.01


def test_recall_where_lists_are_left_out(spark):
    """At 24,000 vectors in clusters (77 lists) and 6,000 without: how many of its lists a query goes to, and what it finds."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((300, 32)) * 2
    clustered = centres[rng.integers(0, 300, 24_000)] + 0.5 * rng.standard_normal((24_000, 32))
    plain = rng.standard_normal((6000, 40))
    for vectors, most in ((clustered, 0.5), (plain, 1.0)):
        visits = []
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
        got = {}
        for r in nearest(v, v.filter("vec_id % 200 = 0")).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hits = 0
        lists = max(1, round(len(vectors) ** 0.5 / 2))
        index = Index().fit(vectors, lists)
        own = index.encode(vectors)[0]
        counts = np.bincount(own, minlength=lists)
        for q in range(0, len(vectors), 200):
            score = vectors @ vectors[q]
            score[q] = -np.inf
            best = np.argsort(-score)[:20]
            hits += len(got[q] & set(best.tolist()))
            visits.append(index.lists_for(vectors[q : q + 1], np.array([score[best[-1]]]), counts, 0.4).mean())
        assert hits / (20 * len(range(0, len(vectors), 200))) >= 0.9
        assert np.mean(visits) <= most


@pytest.mark.parametrize("n,d", [(15, 8), (900, 64)])
def test_recall(spark, n, d):
    rng = np.random.default_rng(n)
    rows = [(i, rng.standard_normal(d)) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(None, rows[0][1]), (2000, None), (2020, [0.0] * d), (2040, [float("nan")] * d), (2060, [None] * d), (2080, [float("inf")] * d), rows[5]]
    v = table(spark, rows)
    got = {}
    for r in nearest(v, v.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows)
    assert set(got) == set(want)
    hits = total = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(best)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += sum(m[2] >= best[-1][1] - 1e-9 for m in mine)
        total += len(best)
        if n < 100:
            assert [(m[1], round(m[2], 9)) for m in mine] == [(i, round(s, 9)) for i, s in best]
    assert hits / total >= 0.9


def test_empty(spark):
    v = table(spark, [])
    assert nearest(v, v).count() == 0
    one = table(spark, [(20, [1.0, 2.0])])
    assert nearest(one, one).count() == 0


def test_odd_dimensions_cost_only_themselves(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6)) for i in range(1, 41)]
    v = table(spark, [*rows, (60, [1.0]), (61, rng.standard_normal(9)), (80, rng.standard_normal(9))])
    got = {}
    for r in nearest(v, v.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert got.pop(80) == {1: 61}
    assert got == {q: {n: i for n, (i, _) in enumerate(best, 1)} for q, best in brute(rows).items()} and set(got) == {20, 40}
    tied = table(spark, [(20, [1.0, 2.0]), (1, [3.0, 1.0]), (40, [1.0]), (2, [2.0])])
    assert sorted((r.query_id, r.vec_id) for r in nearest(tied, tied.filter("vec_id % 20 = 0")).collect()) == [(20, 1), (40, 2)]


def test_doubles_are_not_rounded_and_an_id_may_have_several_vectors(spark):
    rows = [(i, [1e9 + i, 1e9]) for i in range(1, 100)] + [(100, [1e9, 1e9])]
    v = spark.createDataFrame([(i, [float(x) for x in e]) for i, e in rows], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in sorted(nearest(v, v.filter("vec_id = 100"), k=3).collect(), key=lambda r: r["rank"])]
    assert got == [99, 98, 97]
    rng = np.random.default_rng(8)
    few = [(i, rng.standard_normal(5)) for i in range(1, 60)] + [(20, rng.standard_normal(5)) for _ in range(30)] + [(7, rng.standard_normal(5))]
    v = spark.createDataFrame([(i, e.tolist()) for i, e in few], "vec_id long, embedding array<double>")
    best = {}
    for i, e in few:
        if i != 20:
            best[i] = max([best.get(i, -np.inf)] + [float((e * q).sum()) for j, q in few if j == 20])
    want = sorted(best, key=lambda i: -best[i])[:20]
    got = sorted(nearest(v, v.filter("vec_id = 20")).collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in got] == want and all(abs(r.score - best[r.vec_id]) < 1e-9 for r in got)
