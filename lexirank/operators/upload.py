"""Plans for writing levels back: updates, a report, marks on the candidate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import INTEGER
from ..schemas import FALLBACK_LEVEL, MARKER_COLUMNS

MODES = ("partial", "full_fallback")


def parse_mode(text: str | None) -> str:
    name = (text or "partial").strip().lower().replace("-", "_")
    if name not in MODES:
        raise ValueError(f"the mode is one of {', '.join(MODES)}")
    return name


def upload_report(final: DataFrame, db: DataFrame, mode: str = "partial") -> DataFrame:
    """word_id, previous_level, new_level, source. partial: of the candidate's words; full_fallback: of the database's, 4 where it has none."""
    final = final.select("word_id", F.col("level").alias("new_level"))
    db = db.select("word_id", F.col("rarity_level").alias("previous_level"))
    if parse_mode(mode) == "partial":
        there = F.col("previous_level").isNotNull() | F.col("in_db").isNotNull()
        rows = final.join(db.withColumn("in_db", F.lit(True)), "word_id", "left")
        return rows.select(
            "word_id", "previous_level", F.when(there, F.col("new_level")).alias("new_level"), F.when(there, "final_csv").otherwise("missing_db_word").alias("source")
        )
    rows = db.join(final, "word_id", "left")
    return rows.select(
        "word_id", "previous_level", F.coalesce("new_level", F.lit(FALLBACK_LEVEL)).alias("new_level"), F.when(F.col("new_level").isNotNull(), "final_csv").otherwise("fallback_4").alias("source")
    )


def upload_updates(report: DataFrame) -> DataFrame:
    return report.where("source <> 'missing_db_word'").select("word_id", F.col("new_level").alias("rarity_level"))


def upload_status(final: DataFrame, db: DataFrame) -> DataFrame:
    """Of each candidate word: uploaded, or missing_db_word; alike in both modes."""
    there = db.select("word_id", F.lit(True).alias("there"))
    return final.join(there, "word_id", "left").select("word_id", "level", F.when(F.col("there"), "uploaded").otherwise("missing_db_word").alias("status"))


def apply_updates(db: DataFrame, updates: DataFrame) -> DataFrame:
    """The database's next snapshot, in its columns."""
    new = updates.select("word_id", F.col("rarity_level").alias("_new"))
    return db.join(new, "word_id", "left").withColumn("rarity_level", F.coalesce("_new", "rarity_level")).select(*db.columns)


def mark_uploaded(candidate: DataFrame, status: DataFrame, *, uploaded_at: Column, batch_id: str) -> DataFrame:
    """The candidate with marker columns: filled where there is a status, else as they were, or empty. Ids that are no numbers stay unmarked."""
    text = F.col("word_id").cast("string")
    key = F.when(text.rlike(INTEGER), F.trim(text)).try_cast("long")
    found = status.select(F.col("word_id").alias("_id"), F.col("level").alias("_level"), F.col("status").alias("_status"))
    values = {
        "uploaded_at": uploaded_at.cast("string"),
        "uploaded_level": F.when(F.col("_status") == "uploaded", F.col("_level").cast("string")).otherwise(F.lit("")),
        "upload_status": F.col("_status"),
        "upload_batch_id": F.lit(batch_id),
    }
    rows = candidate.withColumn("_key", key).join(found, F.col("_key") == F.col("_id"), "left")
    old = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in candidate.columns else F.lit("")
    marks = {c: F.when(F.col("_status").isNotNull(), values[c]).otherwise(old(c)) for c in MARKER_COLUMNS}
    return rows.withColumns(marks).drop("_key", "_id", "_level", "_status")


def companion_markers(candidate: DataFrame, status: DataFrame, *, uploaded_at: Column, batch_id: str) -> DataFrame:
    """The marks alone, by id: for a candidate that can't be rewritten."""
    marked = mark_uploaded(candidate.select("word_id"), status, uploaded_at=uploaded_at, batch_id=batch_id)
    return marked.where("upload_status <> ''").orderBy("word_id")


def upload(final: DataFrame, db: DataFrame, mode: str = "partial", *, audit: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(next snapshot, report, status). With an audit, a candidate that fails it is not uploaded."""
    if audit is not None and not audit.first()["passed"]:
        raise ValueError("the candidate fails the audit")
    report = upload_report(final, db, mode)
    return apply_updates(db, upload_updates(report)), report, upload_status(final, db)
