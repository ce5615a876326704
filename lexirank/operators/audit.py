"""Quality gates over sets of the commonest words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The release gate.
MIN_JACCARD, MIN_PRECISION, MIN_RECALL = 0.80, 0.90, 0.70


def level_one(df: DataFrame, level: str, value) -> DataFrame:
    return df.where(F.col(level) == 1).select(value.alias("v")).where(F.col("v").isNotNull() & (F.col("v").cast("string") != "")).distinct()


def set_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: n_a, n_b, n_both of two tables of distinct values v, by one pre-aggregated union."""
    both = a.select("v", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("v", F.lit(0).alias("a"), F.lit(1).alias("b")))
    per = both.groupBy("v").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_b"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("n_both"))


def ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(0.0)


def quality_audit(
    candidate: DataFrame,
    level: str,
    reference: DataFrame | None = None,
    reference_level: str | None = None,
    anchors: DataFrame | None = None,
    *,
    min_jaccard: float = MIN_JACCARD,
    min_precision: float = MIN_PRECISION,
    min_recall: float = MIN_RECALL,
) -> DataFrame:
    """One row: l1_jaccard with the reference's ids, anchor precision and recall of words, failures and passed.

    Words are distinct, trimmed and in lower case; what is not compared is null and cannot fail.
    """
    none = F.lit(None).cast("double")
    out = candidate.sparkSession.range(1).select()
    if reference is not None:
        ids = set_overlap(level_one(candidate, level, F.col("word_id")), level_one(reference, reference_level or level, F.col("word_id")))
        out = out.crossJoin(ids.select(ratio(F.col("n_both"), F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("l1_jaccard")))
    else:
        out = out.withColumn("l1_jaccard", none)
    if anchors is not None:
        words = set_overlap(level_one(candidate, level, F.lower(F.trim("word"))), anchors.select(F.col("anchor").alias("v")).distinct())
        out = out.crossJoin(words.select(ratio(F.col("n_both"), F.col("n_a")).alias("anchor_precision"), ratio(F.col("n_both"), F.col("n_b")).alias("anchor_recall")))
    else:
        out = out.withColumns({"anchor_precision": none, "anchor_recall": none})
    gates = (("l1_jaccard", min_jaccard), ("anchor_precision", min_precision), ("anchor_recall", min_recall))
    failures = F.array_compact(F.array(*[F.when(F.col(c) < least, F.lit(f"{c}<{least}")) for c, least in gates]))
    return out.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)
