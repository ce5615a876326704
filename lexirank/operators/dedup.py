"""One row per key: the last or first occurrence, by an explicit sequence column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, seq: Column | str) -> DataFrame:
    """Of each key the row with the greatest seq. A partial aggregation: a key with very many rows costs no sort."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.max_by(row, seq).alias("_row")).select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def first_wins(df: DataFrame, key: str, seq: Column | str) -> DataFrame:
    """Of each key the row with the least seq."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.min_by(row, seq).alias("_row")).select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def overlay(file: DataFrame, memory: DataFrame, key: str = "word_id") -> DataFrame:
    """Rows of both by key, those in memory before those in the file, in the file's columns."""
    both = file.withColumn("_prio", F.lit(0)).unionByName(memory.withColumn("_prio", F.lit(1)), allowMissingColumns=True)
    return last_wins(both, key, "_prio").select(*file.columns)


def run_baseline(run: DataFrame, key: str = "word_id") -> DataFrame:
    """Count, least and greatest id; nulls for an empty run."""
    return run.agg(F.count(F.lit(1)).alias("row_count"), F.min(key).alias("min_id"), F.max(key).alias("max_id"))


def guarded_rewrite(file: DataFrame, memory: DataFrame, key: str = "word_id") -> DataFrame:
    """overlay(), sorted; an error if it has fewer rows, or a narrower range of ids, than the file."""
    merged = overlay(file, memory, key)
    before, after = run_baseline(file, key).first(), run_baseline(merged, key).first()
    if before.row_count and (after.row_count < before.row_count or after.min_id > before.min_id or after.max_id < before.max_id):
        raise ValueError(f"a rewrite may not shrink: {before} before, {after} after")
    return merged.orderBy(key)
