"""The operators' inputs as views over the sample tables, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import last_wins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("word_id"), F.col("c_name").alias("word"), F.col("c_mktsegment").alias("type"))


def run_log(spark, d) -> DataFrame:
    """Every order is a label of its customer; orders are dealt to four runs by their key."""
    level = F.substring("o_orderpriority", 1, 1).cast("int").alias("rarity_level")
    sure = (((F.col("o_orderkey") * 37) % 101) / 100.0).alias("confidence")
    return table(spark, d, "orders").select(F.col("o_custkey").alias("word_id"), level, sure, F.col("o_orderkey").alias("seq"), (F.col("o_orderkey") % 4).alias("run"))


def run(spark, d, number: int) -> DataFrame:
    return last_wins(run_log(spark, d).where(F.col("run") == number), "word_id", "seq")


def db_levels(spark, d) -> DataFrame:
    """The fourth run's labels stand for the database: it lacks some words."""
    return run(spark, d, 3).select("word_id", "rarity_level")


def final_levels(spark, d) -> DataFrame:
    return run(spark, d, 0).select("word_id", F.col("rarity_level").alias("level"))


def pool(spark, d) -> DataFrame:
    orders = table(spark, d, "orders")
    return orders.select(F.col("o_orderkey").alias("word_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("level"), F.col("o_totalprice").alias("score"))


def anchors(spark, d) -> DataFrame:
    return table(spark, d, "customer").where("c_nationkey < 5").select(F.lower("c_name").alias("anchor")).distinct()


def review_items(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("word_id"), (F.col("n_chars") % 5 + 1).cast("int").alias("level"), (((F.col("doc_id") * 37) % 101) / 100.0).alias("confidence"))


def review_labels(spark, d) -> DataFrame:
    label = F.when(F.col("toxic") == 1, "undecided").when(F.col("quality") == 1, "1").otherwise("unknown_4_5")
    return table(spark, d, "labels").select(F.col("doc_id").alias("word_id"), F.lit(1).alias("predicted_level"), label.alias("label"))


SQL = """
WITH base AS (SELECT c_custkey AS word_id, c_name AS word, c_mktsegment AS type FROM customer),
run_log AS (SELECT o_custkey AS word_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS rarity_level, ((o_orderkey * 37) % 101) / 100.0 AS confidence, o_orderkey AS seq, o_orderkey % 4 AS run FROM orders),
last AS (SELECT * FROM run_log QUALIFY row_number() OVER (PARTITION BY run, word_id ORDER BY seq DESC) = 1),
run_a AS (SELECT * FROM last WHERE run = 0), run_b AS (SELECT * FROM last WHERE run = 1), run_c AS (SELECT * FROM last WHERE run = 2),
db AS (SELECT word_id, rarity_level FROM last WHERE run = 3),
final AS (SELECT word_id, rarity_level AS level FROM run_a),
pool AS (SELECT o_orderkey AS word_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS level, o_totalprice AS score FROM orders),
anchors AS (SELECT DISTINCT lower(c_name) AS anchor FROM customer WHERE c_nationkey < 5),
items AS (SELECT doc_id AS word_id, CAST(n_chars % 5 + 1 AS INT) AS level, ((doc_id * 37) % 101) / 100.0 AS confidence FROM documents),
labelled AS (SELECT doc_id AS word_id, 1 AS predicted_level, CASE WHEN toxic = 1 THEN 'undecided' WHEN quality = 1 THEN '1' ELSE 'unknown_4_5' END AS label FROM labels)
"""
