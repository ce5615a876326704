"""Review of uncertain labels by people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import last_wins

DECIDED = ("1", "2", "3", "unknown_4_5")


def parse_only_levels(text: str | None) -> set[int] | None:
    """"1,3" as a set of levels; blank means all."""
    if not text or not text.strip():
        return None
    parts = [p.strip() for p in text.split(",") if p.strip()]
    if not all(p.isdecimal() and 1 <= int(p) <= 5 for p in parts):
        raise ValueError(f"levels are 1 to 5: {text!r}")
    return {int(p) for p in parts}


def review_items(run: DataFrame, level: str, only: set[int] | None = None) -> DataFrame:
    """word_id, predicted_level, confidence of the rows to review; without a confidence column it is 1."""
    confidence = F.coalesce(F.col("confidence").cast("double"), F.lit(1.0)) if "confidence" in run.columns else F.lit(1.0)
    rows = run.where(F.col(level).isin(*only)) if only else run
    extra = [c for c in ("word", "type") if c in run.columns]
    return rows.select("word_id", *extra, F.col(level).cast("int").alias("predicted_level"), confidence.alias("confidence"))


def latest_labels(labels: DataFrame, seq: str) -> DataFrame:
    return last_wins(labels, "word_id", seq)


def review_queue(items: DataFrame, labels: DataFrame, *, include_undecided: bool = False, most: int = 0) -> DataFrame:
    """Items without a label, and undecided ones if asked for, least confident first; at most so many if over 0."""
    known = labels.select("word_id", "label") if not include_undecided else labels.select("word_id", "label").where("label <> 'undecided'")
    queue = items.join(known.select("word_id"), "word_id", "left_anti").orderBy("confidence", "word_id")
    return queue.limit(most) if most > 0 else queue


def review_stats(labels: DataFrame) -> DataFrame:
    """One row: reviewed (predicted 1 and decided), accepted (label 1), precision."""
    asked = (F.col("predicted_level") == 1) & F.col("label").isin(*DECIDED)
    counts = labels.agg(F.count_if(asked).alias("reviewed"), F.count_if(asked & (F.col("label") == "1")).alias("accepted"))
    return counts.withColumn("precision", F.when(F.col("reviewed") > 0, F.col("accepted") / F.col("reviewed")).otherwise(0.0))


def review_gate(labels: DataFrame, *, min_precision: float = 0.90, min_reviewed: int = 1) -> DataFrame:
    """review_stats() and whether they pass."""
    stats = review_stats(labels)
    return stats.withColumn("passed", (F.col("precision") >= min_precision) & (F.col("reviewed") >= min_reviewed))
