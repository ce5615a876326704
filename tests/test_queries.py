import glob
import os

import duckdb
import pandas as pd
import pytest

from lexirank.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame):
    def cell(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return None
        return round(float(x), 9) if isinstance(x, float) else x.item() if hasattr(x, "item") else x

    return sorted((tuple(cell(x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_fuzzy_answers(spark):
    from lexirank.functions import responses

    words = spark.createDataFrame([(0, 1, "țară", "N"), (0, 2, "padure", "N"), (0, 3, "tara", "V")], "batch long, word_id long, word string, type string")
    answers = spark.createDataFrame([(0, '[{"word": "tarra", "type": "N", "rarity_level": 2}, {"word": "munte", "type": "N", "rarity_level": 1}]')], "batch long, response string")
    from pyspark.sql import functions as F

    results = responses.valid_results(answers.withColumn("nodes", responses.result_nodes(F.col("response"))))
    assert [(r.word_id, r.rarity_level) for r in responses.match_fuzzy(words, results).collect()] == [(1, 2)]


@pytest.mark.parametrize("name", ["run_scan", "final_level_scan"])
def test_sorted_logs_are_written_by_many_tasks(spark, duck, monkeypatch, name):
    """No file has all rows; by name and place they are in the log's order, and the last of each word is the SQL's."""
    from lexirank.plans import queries
    from lexirank.sources import tables

    paths, write = [], queries.sinks.write_csv
    monkeypatch.setattr(queries.sinks, "write_csv", lambda df, path, **more: (paths.append(path), write(df, path, **more)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(got) == rows(duck.execute(ORACLE_SQL[name]).df())
    log = duck.execute("SELECT o_custkey, substr(o_orderpriority, 1, 1) FROM orders ORDER BY o_orderkey").fetchall()
    level = "rarity_level" if name == "run_scan" else "final_level"
    read = tables.read_in_order(spark, paths[0]).orderBy("seq").collect()
    assert [(int(r.word_id), r[level]) for r in read] == log
    sizes = [x["count"] for x in spark.read.text(paths[0]).groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) > 2 and max(sizes) < len(log) / 2
