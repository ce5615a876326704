import pytest

#: What any column may hold: nulls, empty and very long texts, repeated rows, repeated and null ids.
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs into the dark wood at night", "en", "s0"),
    (1, "The quick brown fox jumps over the lazy dog and runs into the dark wood at night", "en", "s0"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs into the dark wood at night", "en", None),
    (3, "", "en", "s1"),
    (4, None, None, None),
    (None, "the quick brown fox jumps over the lazy dog and runs into the dark wood at night", "fr", "s1"),
    (None, None, None, None),
    (5, "é ü 日本語 a\n\n b\t\tc  ", "ja", "s2"),
    (6, LONG, "en", "s0"),
    (7, "one two", "en", "s0"),
    (8, "one two", "en", "s0"),
    (9, "a<|endoftext|>b", "en", "s0"),
]
#: Columns whose names the operators use for themselves.
CLASHING = ("score", "key", "doc", "n_words", "spans", "blob", "set_id", "part", "row", "learn", "held_out", "label", "start")


@pytest.fixture(scope="session")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, len(r[1] or ""), *[f"x{c}" for c in CLASHING]) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
