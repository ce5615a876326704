"""Input for trying failed words again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import INTEGER


def failed_ids(lines: DataFrame, line_col: str = "value", field: str = "word_id") -> DataFrame:
    """Distinct ids of a log of JSON lines; blank and unreadable lines, and ids that are no whole numbers, are skipped."""
    text = F.get_json_object(line_col, f"$.{field}")
    return lines.select(F.when(text.rlike(INTEGER), F.trim(text)).try_cast("long").alias("word_id")).where("word_id is not null").distinct()


def retry_input(base: DataFrame, failed: DataFrame, key: str = "word_id") -> DataFrame:
    """Base rows of failed words, with all their columns and repetitions."""
    return base.join(failed.select(F.col("word_id").alias("_failed")), F.col(key) == F.col("_failed"), "left_semi")


def pending_words(base: DataFrame, run: DataFrame, *, force: bool = False, most: int = 0) -> DataFrame:
    """Base rows that the run doesn't have, by id; all of them with force; at most so many if over 0."""
    rows = base if force else base.join(run.select("word_id"), "word_id", "left_anti")
    return rows.orderBy("word_id").limit(most) if most > 0 else rows
