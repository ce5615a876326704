import itertools
import random
import re
import string

import pytest

from lexirank.llm import ngram_join as J
from lexirank.llm.components import connected_components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=repr)


def near_copies(seed, groups=12, members=14, length=60, edits=4):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, length * 2))]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: len(text) - rng.randint(0, 3)]
            rows.append((rng.randrange(10**6), " ".join(text)))
    return rows


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_against_all_pairs(spark, k, percent):
    rows = near_copies(k) + [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b"), (None, "a b"), (None, None), (5, "other"), (6, "a b c"), (6, "a b c")]
    got = J.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=k, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, percent)


def test_groups_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_DOCS", 10)
    rows = near_copies(9, groups=3, members=60, length=70, edits=5)
    got = J.link_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=90)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 3, 90)


def test_parts_compared_in_slices(spark, monkeypatch):
    monkeypatch.setattr(J, "HELD_BYTES", 300)
    rows = near_copies(4, groups=4, members=12, length=60, edits=3)
    got = J.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=3, percent=90)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 3, 90)


@pytest.mark.parametrize("share", [1, 60, 250_000])
def test_components_at_every_share_of_a_task(spark, monkeypatch, share):
    """Rounds of stars until nothing changes, until few edges are left, or none at all."""
    from lexirank.llm import components

    monkeypatch.setattr(components, "TASK_EDGES", share)
    monkeypatch.setattr(components, "HELD_EDGES", 40)
    rng = random.Random(share)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(330)] + [(7, 7), (1000, 1001), (1001, 1000)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert found == {x: r for x, r in root.items() if sum(1 for v in root.values() if v == r) > 1}


def test_chains_of_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(30))
    assert all(got[a] == got[b] and got[a] <= min(a, b) for a, b in edges if a != b)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_any_rows(spark, docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = J.link_components(docs, shingle=3, percent=90)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 3, 90)
    assert J.link_components(empty).count() == 0


def test_common_parts_reach_every_set(spark, monkeypatch):
    """Parts that many sets of a task have go by ranges of their own, and no link is lost."""
    monkeypatch.setattr(J, "COMMON", 3)
    rows = near_copies(21, groups=4, members=40, length=50, edits=2)
    got = J.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=3, percent=90)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 3, 90)


def test_lines_that_many_texts_share_make_no_clusters(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(9)) for _ in range(3)]
    rows = []
    for i in range(300):
        own = [f"v{i}x{j}" for j in range(rng.randint(60, 90))]
        at = rng.randrange(len(own))
        rows.append((i, " ".join(own[:at] + [rng.choice(lines)] + own[at:])))
    rows += [(1000 + i, t + " more") for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select("text")
    edges, _ = J.candidate_edges(texts, 5, 80, len(rows), 80 * len(rows))
    clusters = connected_components(edges).groupBy("root").count().collect()
    assert len(clusters) >= 20 and max(r["count"] for r in clusters) < 10
    got = J.link_components(docs, shingle=5, percent=80)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 5, 80)
