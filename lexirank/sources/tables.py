"""Scans of CSV files, JSON lines, word lists and databases. All cells are read as text, then cast: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import INTEGER
from ..operators.dedup import last_wins
from ..schemas import BASE_COLUMNS, CHECKPOINT, MAX_LEVEL, MIN_LEVEL, level_column, require_columns
from .csv_ranges import BadRow, read_ranges

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000", "mode": "PERMISSIVE"}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header, every column as text, "" for an empty cell. A row of another width is an error; blank lines are skipped.

    Read in ranges of bytes, each by a task of its own; where ranges can't be told (see read_ranges), each file by one task.
    """
    return read_in_order(spark, path).drop("seq")


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """read_csv() with seq, the rows' order in the files: by file name, then by place."""
    found = read_ranges(spark, path)
    return read_whole(spark, path) if found is None else found.withColumnRenamed("_seq", "seq")


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """read_in_order() by Spark's own reader, a task for each file."""
    names = spark.read.options(**_CSV).option("inferSchema", "false").csv(path).columns
    if not names:
        raise BadRow(f"{path}: no header")
    schema = StructType([StructField(n, StringType()) for n in [*names, "_corrupt"]])
    rows = spark.read.options(**_CSV).option("columnNameOfCorruptRecord", "_corrupt").schema(schema).csv(path)
    rows = rows.withColumn("seq", F.struct(F.input_file_name(), F.monotonically_increasing_id()))
    wrong = F.concat(F.lit(f"{path}: a row does not fit the header: "), F.col("_corrupt"))
    first = F.when(F.col("_corrupt").isNotNull(), F.raise_error(wrong).cast("string")).otherwise(F.col(names[0]))
    return rows.select(first.alias(names[0]), *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names[1:]], "seq")


def strict(kind: str, column: str, where: str) -> Column:
    """A cell as int, long, double or text that isn't blank; else an error that tells file, column and value."""
    cell = F.trim(F.col(column))
    said = F.raise_error(F.concat(F.lit(f"{where}: {column} is no {kind}: "), F.coalesce(cell, F.lit("null"))))
    if kind == "text":
        return F.when(cell != "", cell).otherwise(said.cast("string"))
    value = F.when(cell.rlike(INTEGER), cell).try_cast(kind) if kind != "double" else cell.try_cast("double")
    return F.when(value.isNotNull(), value).otherwise(said.cast(kind))


def checked_level(column: str, where: str) -> Column:
    level = strict("int", column, where)
    return F.when(level.between(MIN_LEVEL, MAX_LEVEL), level).otherwise(F.raise_error(F.concat(F.lit(f"{where}: {column} is no level: "), F.col(column))).cast("int"))


def read_base(spark: SparkSession, path: str) -> DataFrame:
    """word_id, word, type; repeated words stay."""
    rows = require_columns(read_csv(spark, path), *BASE_COLUMNS)
    return rows.select(strict("long", "word_id", path).alias("word_id"), strict("text", "word", path).alias("word"), strict("text", "type", path).alias("type"))


def read_run(spark: SparkSession, path: str, *, missing_is_empty: bool = True) -> DataFrame:
    """A run, one row for each word: the last in the file. A missing file is an empty run, where that is allowed."""
    if missing_is_empty and not exists(spark, path):
        from ..schemas import RUN

        return spark.createDataFrame([], RUN)
    rows = require_columns(read_in_order(spark, path), *BASE_COLUMNS, "rarity_level", "confidence")
    sure = strict("double", "confidence", path)
    sure = F.when(sure.between(0, 1), sure).otherwise(F.raise_error(F.lit(f"{path}: a confidence is not from 0 to 1")).cast("double"))
    text = lambda c: (F.col(c) if c in rows.columns else F.lit("")).alias(c)
    typed = rows.select(
        strict("long", "word_id", path).alias("word_id"), strict("text", "word", path).alias("word"), strict("text", "type", path).alias("type"),
        checked_level("rarity_level", path).alias("rarity_level"), text("tag"), sure.alias("confidence"), text("scored_at"), text("model"), text("run_slug"), "seq",
    )
    return last_wins(typed, "word_id", "seq").drop("seq")


def read_final_levels(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """word_id and level: of the first level column that is there, the last row of each word."""
    rows = require_columns(read_in_order(spark, path), "word_id")
    level = level_column(rows, column)
    typed = rows.select(strict("long", "word_id", path).alias("word_id"), checked_level(level, path).alias("level"), "seq")
    return last_wins(typed, "word_id", "seq").drop("seq")


def read_levels_table(spark: SparkSession, path: str, column: str | None = None, *, in_order: bool = False) -> DataFrame:
    """All columns and rows, with word_id and level typed: the input of a rebalance. in_order: with seq, the rows' order."""
    rows = require_columns((read_in_order if in_order else read_csv)(spark, path), *BASE_COLUMNS)
    return rows.withColumns({"level": checked_level(level_column(rows, column), path), "word_id": strict("long", "word_id", path)})


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint rows; an unreadable line is an error, a missing file none."""
    if not exists(spark, path):
        return spark.createDataFrame([], CHECKPOINT)
    return spark.read.schema(CHECKPOINT).option("mode", "FAILFAST").json(path)


def anchors_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """anchor: distinct trimmed lower-case lines without blanks and # comments."""
    text = F.lower(F.trim(F.col(column)))
    return lines.select(text.alias("anchor")).where((F.col("anchor") != "") & ~F.col("anchor").startswith("#")).distinct()


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    found = anchors_of(read_lines(spark, path))
    if found.isEmpty():
        raise ValueError(f"{path}: no anchors")
    return found


def read_review_labels(spark: SparkSession, path: str) -> DataFrame:
    """The last label of each word; a missing file has none. Levels are not checked."""
    if not exists(spark, path):
        return spark.createDataFrame([], "word_id long, predicted_level int, label string")
    rows = require_columns(read_in_order(spark, path), "word_id", "predicted_level", "label")
    typed = rows.select(strict("long", "word_id", path).alias("word_id"), strict("int", "predicted_level", path).alias("predicted_level"), F.trim("label").alias("label"), "seq")
    return last_wins(typed, "word_id", "seq").drop("seq")


def database_options(url: str | None = None, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Connection options: arguments before the environment's SUPABASE_DB_URL, _USER and _PASSWORD."""
    import os

    found = {k: v or os.environ.get(f"SUPABASE_DB_{k.upper()}") for k, v in (("url", url), ("user", user), ("password", password))}
    if not found["url"]:
        raise ValueError("no database is named")
    return {k: v for k, v in found.items() if v}


def id_bounds(load, count: int, parts: int) -> list[int]:
    """Ids at which parts of as many rows begin, but for the first: the database's own quantiles, in one question."""
    at = sorted({round(k * count / parts) for k in range(1, parts)} - {0, count})
    if not at:
        return []
    one = "SELECT id FROM (SELECT id FROM words ORDER BY id OFFSET {} ROWS FETCH NEXT 1 ROWS ONLY) q{}"
    rows = load(query=" UNION ALL ".join(one.format(offset, n) for n, offset in enumerate(at)))
    return sorted({int(r[0]) for r in rows.collect()})


def read_words_table(spark: SparkSession, options: dict[str, str], columns: tuple[str, ...] = ("id", "word", "type"), partitions: int = 16) -> DataFrame:
    """The words table by JDBC, in ranges of ids that hold as many rows each, read side by side; only the columns named are fetched."""
    load = lambda **more: spark.read.format("jdbc").options(**options, **more).load()
    count = load(query="SELECT count(*) AS n FROM words").first()[0]
    bounds = id_bounds(load, count, partitions)
    ends = [None, *bounds, None]
    ranges = [" AND ".join(["1 = 1" if low is None else f"id >= {low}", *([] if high is None else [f"id < {high}"])]) for low, high in zip(ends, ends[1:])]
    rest = {k: v for k, v in options.items() if k != "url"}
    rows = spark.read.jdbc(options["url"], "words", predicates=ranges, properties=rest)
    own = {c.lower(): c for c in rows.columns}
    return rows.select(*[F.col(own[c]).alias("word_id" if c == "id" else c) for c in columns])
