"""Schemas of the tables, and the rules for finding columns in files of varying headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

_S, _L, _I, _D = StringType(), LongType(), IntegerType(), DoubleType()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


BASE = _struct(word_id=_L, word=_S, type=_S)
RUN = _struct(word_id=_L, word=_S, type=_S, rarity_level=_I, tag=_S, confidence=_D, scored_at=_S, model=_S, run_slug=_S)
LEVELS = _struct(word_id=_L, rarity_level=_I)
UPLOAD_REPORT = _struct(word_id=_L, previous_level=_I, new_level=_I, source=_S)
REVIEW_LABELS = _struct(ts_utc=_S, run_csv=_S, word_id=_L, word=_S, type=_S, predicted_level=_I, predicted_confidence=_D, label=_S)
SWITCHED = _struct(timestamp=_S, run_slug=_S, model=_S, word_id=_L, word=_S, previous_level=_I, new_level=_I, selected_by_llm=BooleanType(), transition=_S, type=_S)
CHECKPOINT = _struct(
    timestamp=_S, transition=_S, fingerprint=_S, batch=_L, processed_word_ids=ArrayType(_L), switched=ArrayType(_struct(word_id=_L, new_level=_I, rule=_S))
)
PROGRESS = _struct(
    transition=_S, batch=_L, size=_L, target=_I, selected_word_ids=ArrayType(_L), picked_target_ids=ArrayType(_L), switched=_L, remaining=_L, distribution=MapType(_S, _L)
)

#: Columns that files share, and level columns in the order in which the first present one is taken.
BASE_COLUMNS = ("word_id", "word", "type")
MARKER_COLUMNS = ("uploaded_at", "uploaded_level", "upload_status", "upload_batch_id")
LEVEL_COLUMNS = ("final_level", "rarity_level", "median_level")
MIN_LEVEL, MAX_LEVEL, FALLBACK_LEVEL = 1, 5, 4


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def level_column(df: DataFrame, chosen: str | None = None, among: tuple[str, ...] = LEVEL_COLUMNS) -> str:
    """The chosen column, or the first of `among` that the table has."""
    if chosen:
        require_columns(df, chosen)
        return chosen
    for name in among:
        if name in df.columns:
            return name
    raise MissingColumns(f"none of the level columns is there: {', '.join(among)}")
