"""Run logs as a stream: files that a run appends are merged into a table of the latest label of each word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from ..schemas import RUN
from ..sources.versions import VersionedTable

LOG = StructType([*RUN.fields]).add("seq", LongType())


def run_log_stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """Rows of a log of Parquet files (RUN and seq) as they come, so many files at a time."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(path)


def merge_batch(rows: DataFrame, table: str, batch: int, source: str = "run-log") -> None:
    """The next version of a table with a batch's rows: of each word that with the greatest seq. A batch that comes twice is passed over.

    Only the ranges of ids that the batch touches are rewritten, and readers keep the version that they have.
    """
    VersionedTable(rows.sparkSession, table).merge(rows, "word_id", "seq", source=source, batch=batch)


def follow_run_log(spark: SparkSession, path: str, table: str, checkpoint: str) -> StreamingQuery:
    """Merge what is there, and end."""
    stream = run_log_stream(spark, path).writeStream.foreachBatch(lambda rows, batch: merge_batch(rows, table, batch))
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
