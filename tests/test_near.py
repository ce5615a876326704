import random
import time

from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexirank.functions import near, responses

WORD = st.text(alphabet="abă", max_size=9)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(WORD, WORD)
@settings(max_examples=1500, deadline=None)
@example("abc", "cab")
def test_within_reach(a, b):
    a, b = near.folded(a), near.folded(b)
    assert near.within_reach(a, b) == (distance(a, b) <= 2)


@given(st.lists(st.tuples(st.sampled_from("NV"), WORD), max_size=12), st.sampled_from("NV"), WORD)
@settings(max_examples=800, deadline=None)
def test_pieces_find_every_near_word(words, group, word):
    index = near.NearWords()
    for g, w in words:
        index.put(g, w)
    want = [k for k, (g, w) in enumerate(words) if g == group and distance(near.folded(w), near.folded(word)) <= 2]
    assert list(index.near(group, word)) == want


def edited(rng, word):
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(word) + 1)
        word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcdeț") + word[at:], word[:at] + rng.choice("abcdeț") + word[at + 1 :]])
    return word


def test_join_is_that_of_all_pairs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeT", k=rng.randrange(1, 12))) for _ in range(300)]
    left = spark.createDataFrame([(i % 3, i, w) for i, w in enumerate(words)], "batch int, word_id int, word string")
    right = spark.createDataFrame([(i % 3, i, edited(rng, w)) for i, w in enumerate(words)] + [(0, 900, None), (0, 901, "")], "batch int, pos int, w string")
    got = {(r.word_id, r.pos) for r in near.near_pairs(left, right, ["batch"], "word", "w").collect()}
    want = {(i, r.pos) for i, w in enumerate(words) for r in right.collect() if r.w is not None and r.batch == i % 3 and distance(near.folded(w), near.folded(r.w)) <= 2}
    assert got == want and len(want) > 200


def test_twenty_thousand_words_of_one_batch(spark):
    """Both ways of matching, in seconds; of the join only words with a piece in common are compared."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(20_000)]
    misspelt = [w[:4] + "ZZ" + w[5:] for w in words]
    left = spark.createDataFrame([(1, i, w, "N") for i, w in enumerate(words)], "batch int, word_id int, word string, type string")
    right = spark.createDataFrame([(1, i, w, "N", 3, "t", 0.5) for i, w in enumerate(misspelt)], "batch int, pos int, word string, type string, rarity_level int, tag string, confidence double")
    began = time.monotonic()
    found = responses.match_fuzzy(left, right)
    assert found.count() == 20_000
    pieces = lambda df, made: df.select("word_id" if "word_id" in df.columns else "pos", F.explode(made).alias("k"))
    compared = pieces(left, near.kept_pieces(F.col("word"))).join(pieces(right, near.asked_pieces(F.lower("word"))), "k").count()
    assert compared < 100 * 20_000
    rows = responses._waterfall([(i, w, "N") for i, w in enumerate(words)], [{"word": w, "type": "N", "rarity_level": 2} for w in misspelt], True)
    assert {r[6] for r in rows} == {"fuzzy"}
    assert time.monotonic() - began < 60


def test_of_alike_words_the_first_left_is_taken():
    words = [(3, "casa", "N"), (1, "casă", "N"), (1, "casă", "N"), (7, "case", "V")]
    nodes = [{"word": "caso", "type": "N", "rarity_level": 2}, {"word": "casa", "type": "N", "rarity_level": 3}, {"word": "casa", "type": "N", "rarity_level": 4}, {"word_id": 3, "word": "case", "type": "V", "rarity_level": 5}]
    rows = responses._waterfall(words, nodes, True)
    assert [(r[0], r[3], r[6]) for r in rows] == [(3, 2, "fuzzy"), (1, 3, "fuzzy"), (1, 3, "fuzzy"), (7, 5, "word")]
