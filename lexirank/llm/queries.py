"""The queries opN_<name>: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .storage import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import payload_facts, read_records, write_archives

    return payload_facts(read_records(write_archives(table(spark, sf_dir, "pages"))))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import is_contaminated, mark

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import THRESHOLD, crc_of, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of(F.col("doc_id")) % 3 == 1
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = score(docs, model).select(F.col("doc.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


#: The key of op5's surrogates; a deployment gives one of its own.
SURROGATE_KEY = b"demonstration key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import with_surrogates

    done = with_surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY, keep=["doc_id"])
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("entities.kind"))), ",")
    return done.select(F.col("doc.doc_id").alias("doc_id"), F.size("entities").cast("long").alias("n_entities"), kinds.alias("kinds"), "text")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import cotrain_scores

    scored = cotrain_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score_documents

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = score_documents(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import BASE_RULES, secret_spans, span_text

    found = secret_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda x: x["rank"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE_RULES],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import link_components

    return link_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import read_ids, write_ids

    return read_ids(write_ids(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import codebooks_sha256, fit_and_code, with_label_errors

    coded, codebooks = fit_and_code(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import aligned_with_counts

    return aligned_with_counts(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).drop("row")


QUERIES = {f.__name__: f for f in (op1_packing, op2_warc, op3_decontamination, op4_toxicity, op5_pii, op6_quality, op7_lm_scoring, op8_neighbours, op9_secrets, op10_ngram_join, op11_token_output, op12_vector_codes, op13_alignment)}
ORACLE_SQL = {"op2_warc": oracles.OP2, "op3_decontamination": oracles.OP3, "op9_secrets": oracles.OP9, "op10_ngram_join": oracles.OP10, "op12_vector_codes": oracles.OP12}
