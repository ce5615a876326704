"""A pipeline over documents: toxicity, near duplicates, decontamination, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexirank.llm.decontam import is_contaminated, mark
from lexirank.llm.ngram_join import document_key, link_components
from lexirank.llm.packing import pack
from lexirank.llm.queries import table, tokenizer_path
from lexirank.llm.secrets import redacted, secret_spans
from lexirank.llm.sieve import may_be_among
from lexirank.llm.storage import importable, materialize
from lexirank.llm.toxicity import THRESHOLD, score, train


def _columns_of(docs: DataFrame) -> list:
    return [F.col("doc").getField(c).alias(c) for c in docs.columns]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold. All labels may be learned from: nothing here is held out.

    Null and empty texts have a score too; without labels, or with one kind, that kind's share decides.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).filter(F.col("score") < THRESHOLD).select(*_columns_of(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity of 0.8 or more) the document with the smallest id.

    Documents without words are no duplicates of each other and all stay; rows with words that repeat id and text are
    one document. Of a group a document with an id stays before one without; of several with that id that of the
    least hash. Only rows that may have to go are shuffled; the others are told by a filter of fixed size.
    """
    importable(spark)
    found = link_components(docs, shingle=5, percent=80, detail=True).filter("group_id is not null")
    found = materialize(found.select("doc_id", "key", "group_id"), "found")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    keepers = materialize(found.groupBy("group_id").agg(F.min_by("key", rank).alias("keeper")), "keepers")
    gone = found.join(keepers.hint("merge"), "group_id").filter("key <> keeper").select("key", "doc_id").distinct()
    gone = materialize(gone.withColumnsRenamed({"key": "_key", "doc_id": "_id"}), "gone")
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    may_go = may_be_among(gone.select(F.col("_key").alias("key")).unionByName(repeated), "key")
    rows = docs.withColumn("_key", document_key(docs))
    rows = rows.select(F.struct(*[rows[c] for c in docs.columns]).alias("doc"), "_key", (may_go(F.col("_key")) & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).alias("_may"))
    asked = rows.filter("_may").withColumns({"_id": F.col("doc.doc_id").cast("long"), "_text": F.col("doc.text").cast("string")})
    same = (asked["_key"] == gone["_key"]) & asked["_id"].eqNullSafe(gone["_id"])
    left = asked.join(gone.hint("merge"), same, "left_anti").dropDuplicates(["_key", "_id", "_text"])
    return rows.filter("not _may").select("doc").unionByName(left.select("doc")).select(*_columns_of(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated: fewer than a twentieth of their words are in windows of benchmark items."""
    return mark(docs, table(spark, sf_dir, "benchmark")).filter(~is_contaminated()).select(*_columns_of(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each run of secrets replaced by a mark; n_chars, where there is such a column, is that of the new text."""
    text = redacted(F.col("doc").getField("text"), F.col("spans"))
    out = secret_spans(docs).select(*[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows, without their ids' bytes but with a checksum of them."""
    importable(spark)
    return pack(docs, tokenizer_path()).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: Compression lengths and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
