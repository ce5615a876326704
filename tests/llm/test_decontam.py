import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexirank.llm.decontam import is_contaminated, mark, without_spans
from lexirank.llm.fmindex import FmIndex

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items, k=13):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), []
        for name, item in items:
            v = words(item)
            n = min(k, len(v))
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wins] if n else []
            for i in at:
                hit.update(range(i, i + n))
            if at:
                found.append(str(name))
        out.append((len(w), len(hit), sorted(set(found))))
    return out


@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_index_finds_what_a_scan_finds(text, k):
    text = np.array([*text, 0])
    phrases = np.array(np.meshgrid(*[[1, 2, 3]] * k)).reshape(k, -1).T.astype(np.int64)
    index = FmIndex(text, 4)
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high):
        assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(text) - k + 1) if (text[i : i + k] == p).all()]


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
ITEMS = [(1, ITEM), (2, "Short Item!"), (3, ""), (4, None), (10, ITEM), (None, "null named item of some words")]
TEXTS = [ITEM, f"x {ITEM.upper()} y", f"{ITEM[:40]} . {ITEM[40:]}", "a short, item b", "short-item short item short", "", None, " ".join(["pad"] * 500) + " short item", "see the null named item of some words here", ITEM.replace(" ", " \n") + " é " + ITEM, "alpha beta gamma delta", "é" * 50]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_hit string").repartition(2)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = {i: (n, h, [x for x in f if x != "None"]) for i, (n, h, f) in enumerate(brute(TEXTS, ITEMS))}
    for pass_bytes in (1 << 20, 20):
        rows = mark(docs, bench, pass_bytes=pass_bytes).select("doc", "n_words", "n_hit", "items", "spans", is_contaminated().alias("c"), without_spans(F.col("doc.text"), F.col("spans")).alias("rest")).collect()
        assert {r.doc.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows} == want
        for r in rows:
            assert r.c == (want[r.doc.doc_id][1] > 0 and 20 * want[r.doc.doc_id][1] >= want[r.doc.doc_id][0])
            cut = "".join((r.doc.text or "")[s.start : s.end] for s in r.spans)
            assert len(words(" ".join((r.doc.text or "")[s.start : s.end] for s in r.spans))) == want[r.doc.doc_id][1]
            assert len(r.rest or "") + len(cut) == len(r.doc.text or "")


def test_shards_overlap(spark, monkeypatch):
    from lexirank.llm import decontam

    monkeypatch.setattr(decontam.occurrences, "__defaults__", (7,))
    phrases = decontam.Phrases.of([("1", ITEM)], 13)
    block = next(iter(decontam.words(__import__("pyarrow").array([ITEM * 1, f"q {ITEM} q"]), decontam.ALNUM)))
    found = sorted(int(x) for _, _, first in decontam.occurrences(phrases.numbers(block.hashes()), block.bounds, phrases) for x in first)
    assert sorted(set(found)) == [0, 1, 2, 3, 17, 18, 19, 20]


def test_any_rows(spark, docs, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert mark(docs, bench).count() == docs.count() and mark(empty, bench).count() == 0
    none = mark(docs, bench.limit(0)).collect()
    assert len(none) == docs.count() and all(r.n_hit == 0 and not r["items"] for r in none)


def test_spans_are_the_same_in_one_pass_and_in_many(spark):
    docs = spark.createDataFrame([(0, "see one two, three four; and one two"), (1, "three four one two x")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two"), (2, "three four")], "item_id long, text string")
    found = [{r.doc.doc_id: [(s.start, s.end) for s in r.spans] for r in mark(docs, bench, pass_bytes=n).collect()} for n in (1 << 20, 1)]
    assert found[0] == found[1] == {0: [(4, 23), (29, 36)], 1: [(0, 18)]}
    with pytest.raises(ValueError):
        mark(docs, bench, pass_bytes=0)


def test_no_stage_has_two_passes_and_closures_stay_small(spark):
    """Ten passes: each reads what the one before wrote, and the phrases go out as a file."""
    docs = spark.createDataFrame([(i, f"alpha beta{i} gamma delta epsilon") for i in range(10)], "doc_id long, text string")
    bench = spark.createDataFrame([(str(i), f"alpha beta{i} gamma") for i in range(10)], "item_id string, text string")
    marked = mark(docs, bench, pass_bytes=10)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {r.doc.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in marked.collect()} == {i: (5, 3, [str(i)]) for i in range(10)}
