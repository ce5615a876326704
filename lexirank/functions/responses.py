"""Reading a scorer's answers: labels of a batch's words, or a selection of them."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scalars as S
from .near import NearWords, near_pairs

RESULT = "array<struct<word_id:string,word:string,type:string,rarity_level:string,tag:string,confidence:string>>"


def result_nodes(json_text: Column) -> Column:
    """The objects of a results array, all fields as text; null where the text is no such array."""
    return F.from_json(S.results_text(json_text), RESULT)


def valid_results(answers: DataFrame, nodes: str = "nodes") -> DataFrame:
    """A row for each node with a level of 1 to 5: pos, word_id, word, type, rarity_level, tag, confidence."""
    node = lambda f: F.col("node").getField(f)
    rows = answers.select("batch", F.posexplode(nodes).alias("pos", "node")).where("node is not null")
    rows = rows.select(
        "batch", "pos", S.to_int(node("word_id")).alias("word_id"), S.text_or_null(node("word")).alias("word"), S.text_or_null(node("type")).alias("type"),
        S.to_int(node("rarity_level")).alias("rarity_level"), S.tag(node("tag")).alias("tag"), S.confidence(node("confidence")).alias("confidence"),
    )
    return rows.where(F.col("rarity_level").between(1, 5))


def match_by_id(batch: DataFrame, results: DataFrame) -> DataFrame:
    """The first result of each of the batch's ids; its word isn't compared."""
    first = results.where("word_id is not null").withColumn("n", F.row_number().over(Window.partitionBy("batch", "word_id").orderBy("pos"))).where("n = 1")
    return batch.join(first.select("batch", "word_id", "rarity_level", "tag", "confidence"), ["batch", "word_id"])


def match_by_word(batch: DataFrame, results: DataFrame) -> DataFrame:
    """Words with their k-th result of the same word and type, so that homographs get one each, in order."""
    k = lambda order: F.row_number().over(Window.partitionBy("batch", "word", "type").orderBy(order))
    right = results.where("word is not null").withColumn("k", k("pos")).select("batch", "word", "type", "k", "rarity_level", "tag", "confidence")
    return batch.withColumn("k", k("word_id")).join(right, ["batch", "word", "type", "k"]).drop("k")


def match_fuzzy(batch: DataFrame, results: DataFrame) -> DataFrame:
    """Words and results of one batch and type whose spellings nearly match; of a result's words the first, of a word's results the first."""
    right = results.where("word is not null").select("batch", "type", "pos", F.col("word").alias("_w"), "rarity_level", "tag", "confidence")
    pairs = near_pairs(batch, right, ["batch", "type"], "word", "_w")
    first = pairs.groupBy("batch", "pos").agg(F.min_by(F.struct(*batch.columns, "rarity_level", "tag", "confidence"), "word_id").alias("r")).select("r.*", "pos")
    return first.withColumn("n", F.row_number().over(Window.partitionBy("batch", "word_id").orderBy("pos"))).where("n = 1").drop("n", "pos")


def parse_batches(batches: DataFrame, strict: bool = True) -> DataFrame:
    """Exact waterfall of a batch's results: by id, then word and type, then spelling; each result takes one word, each word one result.

    batches: batch, words (array of word_id, word, type), response (JSON text). A word without a result has a null level.
    Which word a result takes depends on what earlier ones took, so a batch, of bounded size, is one Python call.
    """
    fields = "batch long, word_id long, word string, type string, rarity_level int, tag string, confidence double, matched string, stage string"

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .repair import parse_content

        for frame in frames:
            rows = []
            for batch, words, response in zip(frame["batch"], frame["words"], frame["response"]):
                node, stage = parse_content(response)
                rows += [(batch, *r, stage) for r in _waterfall([tuple(w.values()) if isinstance(w, dict) else tuple(w) for w in words], _nodes(node), strict)]
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")]).astype({"rarity_level": "Int32"})

    return batches.select("batch", "words", "response").mapInPandas(parse, fields)


def _nodes(text: str | None) -> list[dict]:
    value = json.loads(text) if text else []
    if isinstance(value, dict):
        lists = [value[k] for k in ("results", "items", "data", "predictions") if isinstance(value.get(k), list)]
        lists += [v for v in value.values() if isinstance(v, list)]
        value = lists[0] if lists else [value]
    return [x for x in value if isinstance(x, dict)]


def _whole(x) -> int | None:
    if isinstance(x, bool) or isinstance(x, int):
        return int(x)
    return int(x) if isinstance(x, str) and x.strip().lstrip("+-").isdecimal() else None


def _sure(x) -> float:
    try:
        value = float(x)
    except (TypeError, ValueError):
        return 0.5
    return value if 0 <= value <= 1 else value / 100 if 1 < value <= 100 else 0.5


def _waterfall(words: list[tuple], nodes: list[dict], strict: bool) -> list[tuple]:
    """A row for each word: of the nodes in order, each takes the word of its id, else the first of its word and type left, else the first left that nearly matches."""
    ids = [int(w[0]) for w in words]
    by_id = {i: k for k, i in reversed(list(enumerate(ids)))}
    by_word: dict[tuple, deque[int]] = {}
    near: NearWords | None = None
    for k, w in enumerate(words):
        by_word.setdefault((w[1], w[2]), deque()).append(k)
    taken: dict[int, tuple] = {}
    gone: set[int] = set()
    for node in nodes:
        level = _whole(node.get("rarity_level"))
        if level is None or not 1 <= level <= 5:
            continue
        number, word, kind = _whole(node.get("word_id")), str(node.get("word") or "").strip(), str(node.get("type") or "").strip()
        how, found = "id", by_id.get(number)
        if found is None or ids[found] in gone:
            same = by_word.get((word, kind), ()) if word else ()
            while same and ids[same[0]] in gone:
                same.popleft()
            how, found = "word", same[0] if same else None
        if found is None and word:
            if near is None:
                near = NearWords()
                for w in words:
                    near.put(w[2], w[1])
            how, found = "fuzzy", next((k for k in near.near(kind, word) if ids[k] not in gone), None)
        if found is not None:
            gone.add(ids[found])
            taken[ids[found]] = (*words[found], level, (str(node.get("tag") or "").strip() or "uncertain")[:16], _sure(node.get("confidence")), how)
    if strict and words and not taken:
        raise ValueError(f"no valid results parsed from {len(nodes)} result nodes")
    return [taken.get(int(w[0]), (*w, None, None, None, "unresolved")) for w in words]


def select_local_ids(answers: DataFrame) -> DataFrame:
    """Strict selections: answers (batch, size, expected, response: a JSON array of local ids) as batch, picks, surplus, invalid, error.

    The first `expected` distinct ids of 1 to size are picked; ids out of range are counted and dropped; too few are an error.
    """
    ids = F.from_json("response", "array<string>")
    numbers = F.transform(ids, S.to_int)
    valid = F.array_distinct(F.filter(numbers, lambda x: x.between(1, F.col("size"))))
    rows = answers.select("batch", "size", "expected", valid.alias("valid"), F.size(F.filter(numbers, lambda x: ~F.coalesce(x.between(1, F.col("size")), F.lit(False)))).alias("invalid"))
    short = F.coalesce(F.size("valid"), F.lit(0)) < F.col("expected")
    return rows.select(
        "batch",
        F.when(~short, F.slice("valid", F.lit(1), F.col("expected"))).alias("picks"),
        F.greatest(F.coalesce(F.size("valid"), F.lit(0)) - F.col("expected"), F.lit(0)).alias("surplus"),
        F.coalesce("invalid", F.lit(0)).alias("invalid"),
        F.when(short, F.format_string("expected exactly %d selected, got %d", "expected", F.coalesce(F.size("valid"), F.lit(0)))).alias("error"),
    )
