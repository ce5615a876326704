"""Level histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import INTEGER
from ..schemas import MAX_LEVEL, MIN_LEVEL


def histogram(df: DataFrame, level: str) -> DataFrame:
    """level and n for each of 1 to 5, 0 where there are none; other levels are not counted. One aggregation to one row."""
    counts = df.agg(*[F.count_if(F.col(level) == x).alias(str(x)) for x in range(MIN_LEVEL, MAX_LEVEL + 1)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(x).alias("level"), F.col(str(x)).alias("n")) for x in range(MIN_LEVEL, MAX_LEVEL + 1)])))


def strict_level(value: Column) -> Column:
    """A level from text; what is no level is an error that names it."""
    text = F.trim(value.cast("string"))
    number = F.when(text.rlike(INTEGER), text).try_cast("int")
    said = F.concat(F.lit("not a level from 1 to 5: "), F.coalesce(text, F.lit("null")))
    return F.when(number.between(MIN_LEVEL, MAX_LEVEL), number).otherwise(F.raise_error(said).cast("int"))


def rarity_distribution(df: DataFrame, level: str) -> DataFrame:
    """level, n and pct of all rows; a value that is no level is an error."""
    counts = histogram(df.select(strict_level(F.col(level)).alias("level")), "level")
    total = F.sum("n").over(_whole())
    return counts.select("level", "n", F.when(total > 0, 100.0 * F.col("n") / total).otherwise(0.0).alias("pct"))


def _whole():
    """A window over the five rows of a histogram."""
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(0))


def distribution_text(counts: DataFrame) -> DataFrame:
    """One row: each level as level:count(percentage)."""
    part = F.format_string("%d:%d(%.1f%%)", F.col("level"), F.col("n"), F.col("pct"))
    return counts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("level", part.alias("t")))), lambda x: x["t"]), " ").alias("distribution"))


def level_count(df: DataFrame, level: str, wanted: int) -> DataFrame:
    """How many rows have a level; what is no number counts as none."""
    text = F.trim(F.col(level).cast("string"))
    return df.agg(F.count_if(F.when(text.rlike(INTEGER), text).try_cast("int") == wanted).alias("n"))
