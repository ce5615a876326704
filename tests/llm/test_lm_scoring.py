import itertools
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lexirank.llm import lm_scoring as L
from lexirank.llm import queries
from lexirank.llm.hmm import Hmm

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def model(k=3, m=4, seed=2):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return Hmm(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((m, k)), 0))


def likelihood(h, seq, state=None):
    """Sums over all paths; state: (time, state) that the path goes through."""
    total = 0.0
    for path in itertools.product(range(len(h.start)), repeat=len(seq)):
        p = h.start[path[0]] * h.emits[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= h.moves[path[t - 1], path[t]] * h.emits[seq[t], path[t]]
        if state is None or path[state[0]] == state[1]:
            total += p
    return total


def flat(seqs):
    return np.concatenate([np.array(s, dtype=np.uint16) for s in seqs]), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])


def test_recursions_against_all_paths():
    h, seqs = model(), [[0, 1, 2], [3], [], [2, 2, 1, 0, 3], [1, 0]]
    want = [math.log10(likelihood(h, s)) if s else 0.0 for s in seqs]
    assert np.allclose(h.log10(*flat(seqs)), want)
    start, moves, emits = h.expect(*flat(seqs))
    for s in range(3):
        assert np.isclose(start[s], sum(likelihood(h, q, (0, s)) / likelihood(h, q) for q in seqs if q))
        for c in range(4):
            assert np.isclose(emits[c, s], sum(likelihood(h, q, (t, s)) / likelihood(h, q) for q in seqs for t in range(len(q)) if q[t] == c))
    assert np.isclose(moves.sum(), sum(max(len(q) - 1, 0) for q in seqs))


def test_training_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(0, 3, rng.integers(1, 30)) + 3 * int(i % 2) for i in range(60)]
    share = np.full(6, 1 / 6)
    h, before = Hmm.begin(share, 2, 3), -np.inf
    for _ in range(6):
        now = h.log10(*flat(seqs)).sum()
        assert now >= before - 0.5
        before = now
        h = Hmm.of_counts(*h.expect(*flat(seqs)), share)
    assert before > Hmm.begin(share, 2, 3).log10(*flat(seqs)).sum() + 50


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\n"]


def base(rows, learns):
    c = Counter(t for i, text in rows if learns(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return sorted(((i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows), key=repr)


def test_base_scores_against_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "HELD_WORDS", 40)  # so that most words come by the join
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    learns = lambda i: i is None or i % 2 == 1
    got = L.score_documents(docs, F.col("doc_id") % 2 == 1, rounds=2).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == base(rows, learns)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_and_nothing_to_score(spark, docs, empty):
    got = L.score_documents(docs.where("doc_id is not null"), F.lit(False), rounds=1).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in got)
    assert L.score_documents(empty, F.lit(True), rounds=1).count() == 0


def test_sample_tables(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = queries.op7_lm_scoring(spark, d).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == base(rows, lambda i: not held(i))
    test = [r for r in got if r.held_out]
    assert {r.doc_id for r in test} == {i for i, _ in rows if held(i)}
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
