"""Queries over the sample tables, one for each operator or family, with the SQL that gives the same rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import repair, responses
from ..functions import scalars as S
from ..operators import audit, compare, dedup, distribution, metrics, rebalance, retry, review, scoring, upload
from ..sources import sinks, tables
from ..sources.scratch import scratch_path, written
from ..transitions import parse_transition, parse_transitions
from . import chain, views
from .views import SQL

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = SQL + sql if not sql.lstrip().startswith("WITH") else sql
        return f

    return add


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a table of few files, before work that costs more than moving them: as many tasks as run at once."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


# Merging runs -------------------------------------------------------------------------------------------------------

_JOINED = """, j AS (
    SELECT b.word_id, b.word, b.type, a.rarity_level AS run_a_level, a.confidence AS run_a_confidence, x.rarity_level AS run_b_level,
           x.confidence AS run_b_confidence, c.rarity_level AS run_c_level, c.confidence AS run_c_confidence,
           list_sort(list_filter([a.rarity_level, x.rarity_level, c.rarity_level], lambda v: v IS NOT NULL)) AS l,
           coalesce(a.confidence < 0.55, false) OR coalesce(x.confidence < 0.55, false) OR coalesce(c.confidence < 0.55, false) AS low
    FROM base b LEFT JOIN run_a a USING (word_id) LEFT JOIN run_b x USING (word_id) LEFT JOIN run_c c USING (word_id)),
m AS (SELECT *, CAST(CASE len(l) WHEN 0 THEN 4 WHEN 2 THEN round_even((l[1] + l[2]) / 2.0, 0) ELSE l[(len(l) + 1) // 2] END AS INT) AS median_level,
             CAST(CASE WHEN len(l) < 2 THEN 0 ELSE l[-1] - l[1] END AS INT) AS spread FROM j),
o AS (SELECT *, len(l) >= 2 AND (spread >= 2 OR low) AS is_outlier,
             concat_ws(';', CASE WHEN spread >= 2 THEN 'spread>=2' END, CASE WHEN low THEN 'low_confidence<0.55' END) AS reason FROM m)
"""
_COMPARED = "word_id, word, type, run_a_level, run_a_confidence, run_b_level, run_b_confidence, run_c_level, run_c_confidence, median_level, spread, is_outlier, reason"


def _compared(spark, d, strategy) -> DataFrame:
    return compare.compare_runs(views.base(spark, d), *(views.run(spark, d, i) for i in range(3)), strategy=strategy)


@query(_JOINED + f"SELECT {_COMPARED}, 'median' AS merge_strategy, 'median' AS merge_rule, median_level AS final_level FROM o")
def compare_median(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d, "median")


@query(
    _JOINED
    + f"""SELECT {_COMPARED}, 'any_extremes' AS merge_strategy,
    CASE WHEN list_contains(l, 1) THEN 'any_level_1' WHEN median_level >= 3 AND list_contains(l, 2) THEN 'any_level_2_over_median'
         WHEN median_level IN (3, 4) AND list_contains(l, 5) THEN 'any_level_5_over_median' ELSE 'median_fallback' END AS merge_rule,
    CASE WHEN list_contains(l, 1) THEN 1 WHEN median_level >= 3 AND list_contains(l, 2) THEN 2
         WHEN median_level IN (3, 4) AND list_contains(l, 5) THEN 5 ELSE median_level END AS final_level FROM o"""
)
def compare_any_extremes(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d, "any_extremes")


@query(_JOINED + "SELECT word_id, word, type, run_a_level, run_b_level, run_c_level, spread, reason FROM o WHERE is_outlier")
def compare_outliers(spark: SparkSession, d: str) -> DataFrame:
    return compare.outliers(_compared(spark, d, "median"))


@query("SELECT word_id, rarity_level, confidence, seq FROM last")
def run_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = views.run_log(spark, d)
    return dedup.last_wins(rows.withColumn("key", F.struct("run", "word_id")), "key", "seq").drop("key", "run")


@query("SELECT word_id, rarity_level, confidence, seq FROM run_log QUALIFY row_number() OVER (PARTITION BY word_id ORDER BY seq) = 1")
def run_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_wins(views.run_log(spark, d).drop("run"), "word_id", "seq")


@query("SELECT word_id, coalesce(b.rarity_level, a.rarity_level) AS rarity_level FROM run_a a FULL JOIN run_b b USING (word_id)")
def run_overlay(spark: SparkSession, d: str) -> DataFrame:
    a, b = (views.run(spark, d, i).select("word_id", "rarity_level") for i in (0, 1))
    return dedup.overlay(a, b)


@query("SELECT word_id, coalesce(b.rarity_level, a.rarity_level) AS rarity_level FROM last AS a0 JOIN (SELECT DISTINCT word_id AS w FROM last WHERE run IN (0, 1)) ON w = word_id LEFT JOIN run_a a USING (word_id) LEFT JOIN run_b b USING (word_id) GROUP BY ALL")
def run_guarded_rewrite(spark: SparkSession, d: str) -> DataFrame:
    a, b = (views.run(spark, d, i).select("word_id", "rarity_level") for i in (0, 1))
    return dedup.guarded_rewrite(a, b)


@query("SELECT count(*) AS row_count, min(word_id) AS min_id, max(word_id) AS max_id FROM run_a")
def run_baseline(spark: SparkSession, d: str) -> DataFrame:
    return dedup.run_baseline(views.run(spark, d, 0))


@query("SELECT word_id, word, type FROM base WHERE word_id NOT IN (SELECT word_id FROM run_a)")
def pending_words(spark: SparkSession, d: str) -> DataFrame:
    return retry.pending_words(views.base(spark, d), views.run(spark, d, 0))


# Distributions ------------------------------------------------------------------------------------------------------

_HIST = ", h AS (SELECT level, (SELECT count(*) FROM run_log WHERE rarity_level = level) AS n FROM unnest(range(1, 6)) AS r(level))"


@query(_HIST + "SELECT CAST(level AS INT) AS level, n FROM h")
def level_histogram(spark: SparkSession, d: str) -> DataFrame:
    return distribution.histogram(views.run_log(spark, d), "rarity_level")


@query(_HIST + "SELECT CAST(level AS INT) AS level, n, 100.0 * n / (SELECT count(*) FROM run_log) AS pct FROM h")
def rarity_distribution(spark: SparkSession, d: str) -> DataFrame:
    return distribution.rarity_distribution(views.run_log(spark, d), "rarity_level")


@query(_HIST + "SELECT string_agg(printf('%d:%d(%.1f%%)', level, n, 100.0 * n / (SELECT count(*) FROM run_log)), ' ' ORDER BY level) AS distribution FROM h")
def distribution_line(spark: SparkSession, d: str) -> DataFrame:
    return distribution.distribution_text(rarity_distribution(spark, d))


@query("SELECT count(*) AS n FROM run_log WHERE rarity_level = 4")
def pool_level_count(spark: SparkSession, d: str) -> DataFrame:
    return distribution.level_count(views.run_log(spark, d), "rarity_level", 4)


# Upload -------------------------------------------------------------------------------------------------------------

_PARTIAL = """SELECT word_id, db.rarity_level AS previous_level, CASE WHEN db.word_id IS NOT NULL THEN level END AS new_level,
    CASE WHEN db.word_id IS NOT NULL THEN 'final_csv' ELSE 'missing_db_word' END AS source FROM final LEFT JOIN db USING (word_id)"""
_FULL = """SELECT word_id, rarity_level AS previous_level, coalesce(level, 4) AS new_level, CASE WHEN level IS NULL THEN 'fallback_4' ELSE 'final_csv' END AS source
    FROM db LEFT JOIN final USING (word_id)"""


@query(_PARTIAL)
def upload_partial(spark: SparkSession, d: str) -> DataFrame:
    return upload.upload_report(views.final_levels(spark, d), views.db_levels(spark, d))


@query(_FULL)
def upload_full_fallback(spark: SparkSession, d: str) -> DataFrame:
    return upload.upload_report(views.final_levels(spark, d), views.db_levels(spark, d), "full_fallback")


@query("SELECT word_id, level, CASE WHEN db.word_id IS NULL THEN 'missing_db_word' ELSE 'uploaded' END AS status FROM final LEFT JOIN db USING (word_id)")
def upload_status(spark: SparkSession, d: str) -> DataFrame:
    return upload.upload_status(views.final_levels(spark, d), views.db_levels(spark, d))


@query("SELECT word_id, coalesce(level, rarity_level) AS rarity_level FROM db LEFT JOIN final USING (word_id)")
def upload_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return upload.upload(views.final_levels(spark, d), views.db_levels(spark, d))[0]


_MARKED = """CASE WHEN f.word_id IS NULL THEN '' ELSE '2024-01-01T00:00:00Z' END AS uploaded_at,
    CASE WHEN f.word_id IS NOT NULL AND db.word_id IS NOT NULL THEN CAST(f.level AS VARCHAR) ELSE '' END AS uploaded_level,
    CASE WHEN f.word_id IS NULL THEN '' WHEN db.word_id IS NULL THEN 'missing_db_word' ELSE 'uploaded' END AS upload_status,
    CASE WHEN f.word_id IS NULL THEN '' ELSE 'b1' END AS upload_batch_id
    FROM base LEFT JOIN final f USING (word_id) LEFT JOIN db USING (word_id)"""


def _marks(spark, d):
    status = upload.upload_status(views.final_levels(spark, d), views.db_levels(spark, d))
    return status, {"uploaded_at": F.lit("2024-01-01T00:00:00Z"), "batch_id": "b1"}


@query(f"SELECT word_id, word, type, {_MARKED}")
def upload_markers(spark: SparkSession, d: str) -> DataFrame:
    status, options = _marks(spark, d)
    return upload.mark_uploaded(views.base(spark, d), status, **options)


@query(f"SELECT word_id, {_MARKED} WHERE f.word_id IS NOT NULL")
def upload_companion(spark: SparkSession, d: str) -> DataFrame:
    status, options = _marks(spark, d)
    return upload.companion_markers(views.base(spark, d), status, **options)


# Audit and sets -----------------------------------------------------------------------------------------------------

_SETS = """, ca AS (SELECT DISTINCT word_id FROM run_a WHERE rarity_level = 1), re AS (SELECT DISTINCT word_id FROM run_b WHERE rarity_level = 1),
w AS (SELECT DISTINCT lower(word) AS anchor FROM run_a JOIN base USING (word_id) WHERE rarity_level = 1),
n AS (SELECT (SELECT count(*) FROM ca) AS a, (SELECT count(*) FROM re) AS b, (SELECT count(*) FROM ca JOIN re USING (word_id)) AS x,
             (SELECT count(*) FROM w) AS p, (SELECT count(*) FROM anchors) AS q, (SELECT count(*) FROM w JOIN anchors USING (anchor)) AS y),
g AS (SELECT x / CAST(a + b - x AS DOUBLE) AS l1_jaccard, y / CAST(p AS DOUBLE) AS anchor_precision, y / CAST(q AS DOUBLE) AS anchor_recall FROM n)
"""


@query(
    _SETS
    + """SELECT l1_jaccard, anchor_precision, anchor_recall,
    concat_ws(',', CASE WHEN l1_jaccard < 0.8 THEN 'l1_jaccard<0.8' END, CASE WHEN anchor_precision < 0.9 THEN 'anchor_precision<0.9' END,
              CASE WHEN anchor_recall < 0.7 THEN 'anchor_recall<0.7' END) AS failures,
    l1_jaccard >= 0.8 AND anchor_precision >= 0.9 AND anchor_recall >= 0.7 AS passed FROM g"""
)
def quality_audit(spark: SparkSession, d: str) -> DataFrame:
    candidate = views.run(spark, d, 0).join(views.base(spark, d), "word_id")
    found = audit.quality_audit(candidate, "rarity_level", views.run(spark, d, 1), None, views.anchors(spark, d))
    return found.withColumn("failures", F.array_join("failures", ","))


@query("SELECT DISTINCT lower(trim(line)) AS anchor FROM (SELECT c_mktsegment AS line FROM customer UNION ALL SELECT ' # ' || p_name FROM part UNION ALL SELECT '  ' || p_brand || ' ' FROM part UNION ALL SELECT '') WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%'")
def anchor_scan(spark: SparkSession, d: str) -> DataFrame:
    part = views.table(spark, d, "part")
    lines = views.table(spark, d, "customer").select(F.col("c_mktsegment").alias("value")).unionByName(part.select(F.concat(F.lit(" # "), "p_name").alias("value")))
    lines = lines.unionByName(part.select(F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("value"))).unionByName(spark.range(1).select(F.lit("").alias("value")))
    path = scratch_path(spark, "anchors")
    lines.write.text(path)
    return tables.read_anchors(spark, path)


@query("SELECT (SELECT count(*) FROM (SELECT word_id FROM run_a INTERSECT SELECT word_id FROM run_b)) AS n_both, (SELECT count(*) FROM (SELECT word_id FROM run_a UNION SELECT word_id FROM run_b)) AS n_any, (SELECT count(*) FROM (SELECT word_id FROM run_a EXCEPT SELECT word_id FROM run_b)) AS n_first_only, (SELECT count(*) FROM (SELECT word_id FROM run_a UNION ALL SELECT word_id FROM run_b)) AS n_bag")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    a, b = (views.run(spark, d, i).select(F.col("word_id").alias("v")) for i in (0, 1))
    n = audit.set_overlap(a, b)
    return n.select("n_both", (F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("n_any"), (F.col("n_a") - F.col("n_both")).alias("n_first_only"), (F.col("n_a") + F.col("n_b")).alias("n_bag"))


# Review and retry ---------------------------------------------------------------------------------------------------

_QUEUE = "SELECT i.word_id, i.level AS predicted_level, i.confidence FROM items i LEFT JOIN labelled l USING (word_id) WHERE l.word_id IS NULL"


def _queue(spark, d, **options):
    return review.review_queue(review.review_items(views.review_items(spark, d), "level"), views.review_labels(spark, d), **options)


@query(_QUEUE)
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return _queue(spark, d)


@query(_QUEUE + " OR l.label = 'undecided'")
def review_queue_undecided(spark: SparkSession, d: str) -> DataFrame:
    return _queue(spark, d, include_undecided=True)


@query(_QUEUE + " ORDER BY confidence, word_id LIMIT 20")
def review_top(spark: SparkSession, d: str) -> DataFrame:
    """The twenty least confident: a report of a fixed length."""
    return _queue(spark, d, most=20)


@query(_QUEUE + " AND i.level IN (1, 3)")
def review_only_levels(spark: SparkSession, d: str) -> DataFrame:
    items = review.review_items(views.review_items(spark, d), "level", review.parse_only_levels("1,3"))
    return review.review_queue(items, views.review_labels(spark, d))


_STATS = """, s AS (SELECT count(*) FILTER (label IN ('1', '2', '3', 'unknown_4_5')) AS reviewed, count(*) FILTER (label = '1') AS accepted FROM labelled)
SELECT reviewed, accepted, CASE WHEN reviewed > 0 THEN accepted / CAST(reviewed AS DOUBLE) ELSE 0.0 END AS precision"""


@query(_STATS + " FROM s")
def review_stats(spark: SparkSession, d: str) -> DataFrame:
    return review.review_stats(views.review_labels(spark, d))


@query(_STATS + ", accepted >= 0.9 * reviewed AND reviewed >= 1 AS passed FROM s")
def review_gate(spark: SparkSession, d: str) -> DataFrame:
    return review.review_gate(views.review_labels(spark, d))


_FAILED = ", f AS (SELECT DISTINCT user_id AS word_id FROM events WHERE event_type = 'error' AND event_id % 3 <> 0)"


def _failed(spark, d) -> DataFrame:
    """A log of errors in which every third line is damaged, read back from text."""
    events = views.table(spark, d, "events").where("event_type = 'error'")
    line = F.when(F.col("event_id") % 3 == 0, F.lit('{"word_id": broken')).otherwise(F.to_json(F.struct(F.col("user_id").alias("word_id"), "event_type")))
    path = scratch_path(spark, "failed")
    events.select(line.alias("value")).write.text(path)
    return retry.failed_ids(tables.read_lines(spark, path))


@query(_FAILED + "SELECT word_id FROM f")
def failed_log_scan(spark: SparkSession, d: str) -> DataFrame:
    return _failed(spark, d)


@query(_FAILED + "SELECT word_id, word, type FROM base WHERE word_id IN (SELECT word_id FROM f)")
def retry_input(spark: SparkSession, d: str) -> DataFrame:
    return retry.retry_input(views.base(spark, d), _failed(spark, d))


# Scalars ------------------------------------------------------------------------------------------------------------

_AZ = "translate(text, 'ăâîșțşţĂÂÎȘȚŞŢ', 'aaiststAAISTST')"


@query(f"SELECT doc_id, sha256(lower({_AZ})) AS folded FROM documents")
def fn_normalize(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "documents").select("doc_id", F.sha2(S.normalize(F.col("text")), 256).alias("folded"))


@query("SELECT a.n_name AS a, b.n_name AS b, a.n_name = b.n_name OR (abs(len(a.n_name) - len(b.n_name)) <= 2 AND levenshtein(lower(a.n_name), lower(b.n_name)) <= 2) AS near FROM nation a JOIN nation b USING (n_regionkey)")
def fn_matches(spark: SparkSession, d: str) -> DataFrame:
    n = views.table(spark, d, "nation")
    pairs = n.select("n_regionkey", F.col("n_name").alias("a")).join(n.select("n_regionkey", F.col("n_name").alias("b")), "n_regionkey")
    return pairs.select("a", "b", S.matches(F.col("a"), F.col("b")).alias("near"))


@query("SELECT p_partkey, regexp_replace(replace(lower(trim(p_name || '-' || p_brand)), '-', '_'), '[^a-z0-9_]', '', 'g') AS slug, left(regexp_replace(replace(lower(trim(p_type || '-' || p_name || '-' || p_brand)), '-', '_'), '[^a-z0-9_]', '', 'g'), 40) AS chain_slug FROM part")
def fn_slugs(spark: SparkSession, d: str) -> DataFrame:
    both = F.concat_ws("-", "p_name", "p_brand")
    return views.table(spark, d, "part").select("p_partkey", S.slug(both).alias("slug"), S.chain_slug(F.concat_ws("-", "p_type", "p_name", "p_brand")).alias("chain_slug"))


@query("SELECT event_id, CASE WHEN value BETWEEN 0 AND 1 THEN value WHEN value > 1 AND value <= 100 THEN value / 100 ELSE 0.5 END AS confidence, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS INT) END AS whole, left(event_type || '_with_a_long_tail', 16) AS tag, CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END AS text FROM events")
def fn_cells(spark: SparkSession, d: str) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    return views.table(spark, d, "events").select(
        "event_id",
        S.confidence(F.col("value").cast("string")).alias("confidence"),
        S.to_int(F.when(even, F.concat(F.lit(" "), F.col("event_id").cast("string"))).otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".5")))).alias("whole"),
        S.tag(F.concat("event_type", F.lit("_with_a_long_tail"))).alias("tag"),
        S.text_or_null(F.when(even, F.lit("  ")).otherwise(F.concat(F.lit(" "), "event_type"))).alias("text"),
    )


@query("SELECT c_custkey, lower(c_name) AS word, 'ok:' || c_mktsegment AS content FROM customer")
def fn_answers(spark: SparkSession, d: str) -> DataFrame:
    c = views.table(spark, d, "customer")
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.concat(F.lit("```json\nok:"), "c_mktsegment", F.lit("\n```")).alias("content")).alias("message"))).alias("choices")))
    return c.select("c_custkey", S.selection_word(F.concat(F.lit(' "('), "c_name", F.lit(')!" '))).alias("word"), S.strip_fences(S.model_content(body)).alias("content"))


_MESSAGE = """CASE event_id % 8 WHEN 0 THEN 'Missing field Content' WHEN 1 THEN 'body Truncated at 10' WHEN 2 THEN 'bad DECIMAL' WHEN 3 THEN 'word mismatch'
    WHEN 4 THEN 'the model has Crashed' WHEN 5 THEN 'request timed out' WHEN 6 THEN 'response_format must be json_schema' ELSE event_type END"""
_CATEGORY = "CASE event_id % 8 WHEN 0 THEN 'MISSING_CONTENT' WHEN 1 THEN 'TRUNCATED_JSON' WHEN 2 THEN 'DECIMAL_FORMAT' WHEN 3 THEN 'WORD_MISMATCH' WHEN 4 THEN 'MODEL_CRASH' WHEN 5 THEN 'CONNECTIVITY' ELSE 'OTHER' END"


@query(f"SELECT event_id, {_CATEGORY} AS category, event_id % 8 = 5 AS connectivity, event_id % 8 = 4 AS crash, event_id % 8 = 6 AS no_format, event_id % 8 = 6 AS wants_schema, false AS no_reasoning, false AS empty_parse, false AS miscounted FROM events")
def fn_errors(spark: SparkSession, d: str) -> DataFrame:
    m = F.expr(_MESSAGE)
    return views.table(spark, d, "events").select(
        "event_id", S.error_category(m).alias("category"), S.is_connectivity(m).alias("connectivity"), S.is_model_crash(m).alias("crash"), S.is_format_unsupported(m).alias("no_format"),
        S.wants_schema(m).alias("wants_schema"), S.is_reasoning_unsupported(m).alias("no_reasoning"), S.is_empty_parse(m).alias("empty_parse"), S.is_count_mismatch(m).alias("miscounted"),
    )


@query(f"SELECT {_CATEGORY} AS category, count(*) AS n FROM events GROUP BY 1")
def error_counts(spark: SparkSession, d: str) -> DataFrame:
    return metrics.error_counts(views.table(spark, d, "events").select(F.expr(_MESSAGE).alias("error")))


@query("SELECT event_id, CASE WHEN event_id >= 3600 THEN printf('%dh%dm%ds', event_id // 3600, event_id % 3600 // 60, event_id % 60) WHEN event_id >= 60 THEN printf('%dm%ds', event_id // 60, event_id % 60) ELSE printf('%ds', event_id) END AS duration, CAST(round_even(event_id * 3 / 7.0, 0) AS INT) AS left_share, event_id % 10 >= greatest(1, ceil((event_id % 40) * 0.2)) AS no_schema, least(greatest(40 * (event_id % 300) + 200, 256), 8000) AS score_tokens, least(greatest(24 * (event_id % 300) + 128, 128), 8000, 1024) AS select_tokens FROM events")
def fn_budgets(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return views.table(spark, d, "events").select(
        "event_id", S.duration_text(e).alias("duration"), S.split_expected(e, F.lit(3), F.lit(7)).alias("left_share"), S.disables_schema(e % 10, e % 40).alias("no_schema"),
        S.score_tokens(e % 300, 8000).alias("score_tokens"), S.select_tokens(e % 300, 8000).alias("select_tokens"),
    )


@query("SELECT doc_id, sha256(CASE WHEN len(t) > 500 THEN left(t, 500) || '...' ELSE t END) AS excerpt FROM (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS t FROM documents)".replace("\\\\", "\\"))
def fn_excerpt(spark: SparkSession, d: str) -> DataFrame:
    """An excerpt's length is what the function is for: the whole text is folded first."""
    return views.table(spark, d, "documents").select("doc_id", F.sha2(S.excerpt(F.col("text")), 256).alias("excerpt"))


@query("SELECT p_partkey, 'pick 3 of ' || p_size || ' for ' || p_name AS prompt FROM part")
def fn_render(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "part").select("p_partkey", S.rendered(F.lit("pick {n} of {size} for {name}"), n=F.lit(3), size=F.col("p_size"), name=F.col("p_name")).alias("prompt"))


@query("SELECT event_id, CASE event_id % 7 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN 'unknown_4_5' WHEN 4 THEN 'undecided' WHEN 5 THEN 'skip' END AS label, CASE WHEN event_id % 3 < event_id % 5 THEN '+' WHEN event_id % 3 > event_id % 5 THEN '-' ELSE '=' END AS sign FROM events")
def fn_review_input(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    typed = F.element_at(F.array(*[F.lit(x) for x in (" 1", "2", "3 ", "U", "d", "S", "?")]), (e % 7 + 1).cast("int"))
    return views.table(spark, d, "events").select("event_id", S.review_label(typed).alias("label"), S.switch_sign(e % 5, e % 3).alias("sign"))


# Metrics ------------------------------------------------------------------------------------------------------------

_BATCHES = "WITH b AS (SELECT event_id // 50 AS batch, count(*) FILTER (value < 50) AS scored, count(*) FILTER (value >= 50) AS failed FROM events GROUP BY 1)"


def _batches(spark, d) -> DataFrame:
    e = views.table(spark, d, "events")
    return e.groupBy(F.floor(F.col("event_id") / 50).alias("batch")).agg(F.count_if(F.col("value") < 50).alias("scored"), F.count_if(F.col("value") >= 50).alias("failed"))


@query(_BATCHES + "SELECT count(*) AS batches, CAST(sum(scored) AS BIGINT) AS scored, CAST(sum(failed) AS BIGINT) AS failed, count(*) FILTER (scored > 0 AND failed > 0) AS partial, count(*) FILTER (failed = 0) AS successful, sum(scored) * 60.0 / 90 AS wpm, count(*) FILTER (failed = 0) / CAST(count(*) AS DOUBLE) AS success_rate FROM b")
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = metrics.run_metrics(_batches(spark, d))
    return m.withColumns({"wpm": metrics.throughput(F.col("scored"), F.lit(90)), "success_rate": metrics.success_rate(F.col("successful"), F.col("batches"))})


@query(
    """WITH RECURSIVE o AS (SELECT user_id, list(value ORDER BY event_id) AS v FROM events GROUP BY 1),
    s AS (SELECT user_id, v, 0 AS i, CAST(50 AS BIGINT) AS size FROM o
          UNION ALL
          SELECT user_id, v, i + 1, CASE WHEN r < 0.5 THEN greatest(3, size * 2 // 3) WHEN r > 0.9 THEN least(50, size * 3 // 2) ELSE size END
          FROM (SELECT *, len(list_filter(v[greatest(1, i - 8):i + 1], lambda x: x / 100 >= 0.9)) / CAST(least(i + 1, 10) AS DOUBLE) AS r FROM s WHERE i < len(v)))
    SELECT user_id, CAST(i - 1 AS INT) AS i, size FROM s WHERE i > 0"""
)
def adaptive_batch_size(spark: SparkSession, d: str) -> DataFrame:
    e = views.table(spark, d, "events").select("user_id", "event_id", (F.col("value") / 100).alias("ratio"))
    return metrics.batch_sizes(e, "user_id", "event_id", "ratio", 50)


# Rebalancing --------------------------------------------------------------------------------------------------------

_KEY = "(((word_id % 4294967296) * 2654435761 + 0) % 4294967296)"


def _step_sql(source: str, name: str, low: int, to: int, size: int, ratio: str) -> str:
    """A transition of one level, as CTEs over (word_id, level, score, done)."""
    common, rare = min(to, low if to != low else low + 1), max(to, low if to != low else low + 1)
    target = "t" if to == common else "n - t"
    return f"""{name}_r AS (SELECT word_id, score, row_number() OVER (ORDER BY {_KEY}, word_id) AS rank, count(*) OVER () AS total FROM {source} WHERE level = {low} AND NOT done),
{name}_b AS (SELECT *, (rank - 1) // {size} AS batch, least({size}, total - (rank - 1) // {size} * {size}) AS n FROM {name}_r),
{name}_t AS (SELECT *, CAST(round_even((batch * {size} + n) * {ratio}, 0) - round_even(batch * {size} * {ratio}, 0) AS BIGINT) AS t FROM {name}_b),
{name}_p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY score, word_id) <= {target} AS is_common FROM {name}_t),
{name} AS (SELECT s.word_id, s.score, CASE WHEN p.word_id IS NULL THEN s.level WHEN p.is_common THEN {common} ELSE {rare} END AS level, s.done OR p.word_id IS NOT NULL AS done,
    p.batch, p.t AS target, p.is_common, CASE WHEN p.word_id IS NOT NULL THEN s.level END AS previous_level FROM {source} s LEFT JOIN {name}_p p USING (word_id))"""


_START = ", s0 AS (SELECT *, false AS done FROM pool), "
_ONE = _START + _step_sql("s0", "s1", 4, 4, 600, "CAST(0.4 AS DOUBLE)")


def _one(spark, d):
    t = parse_transition("4:4")
    return t, rebalance.apply_transition(views.pool(spark, d).withColumn("processed", F.lit(False)), t, ratio=0.4)


@query(_ONE + "SELECT word_id, level, batch, CAST(target AS INT) AS target, is_common, previous_level FROM s1")
def rebalance_step(spark: SparkSession, d: str) -> DataFrame:
    return _one(spark, d)[1].select("word_id", "level", "batch", "target", "is_common", "previous_level")


@query(_ONE + "SELECT word_id, previous_level, level AS new_level, is_common AS selected_by_llm, '4:4' AS transition, previous_level || '->' || level || ' (via 4:4)' AS rule FROM s1 WHERE previous_level <> level")
def rebalance_switched(spark: SparkSession, d: str) -> DataFrame:
    t, after = _one(spark, d)
    return rebalance.switched_events(after, t)


@query(_ONE + "SELECT count(*) AS eligible, count(*) FILTER (is_common) AS common_assigned, count(*) FILTER (level <> previous_level) AS switched FROM s1 WHERE previous_level IS NOT NULL")
def rebalance_summary(spark: SparkSession, d: str) -> DataFrame:
    return rebalance.transition_summary(_one(spark, d)[1])


@query(_ONE + "SELECT batch, count(*) AS size, string_agg(word_id, ',' ORDER BY word_id) AS selected, string_agg(word_id, ',' ORDER BY word_id) FILTER (is_common) AS picked, count(*) FILTER (level <> previous_level) AS switched, '4:4' AS transition FROM s1 WHERE batch IS NOT NULL GROUP BY 1")
def rebalance_progress(spark: SparkSession, d: str) -> DataFrame:
    t, after = _one(spark, d)
    rows = rebalance.progress_rows(after, t)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return rows.select("batch", "size", text("selected_word_ids").alias("selected"), F.nullif(text("picked_target_ids"), F.lit("")).alias("picked"), "switched", "transition")


@query(_ONE + "SELECT word_id, level, previous_level IS NOT NULL AS processed FROM s1")
def rebalance_resume(spark: SparkSession, d: str) -> DataFrame:
    """A step's checkpoint is written as JSON lines, read strictly and replayed on the words as they were."""
    t, after = _one(spark, d)
    path = scratch_path(spark, "checkpoint")
    rebalance.checkpoint_rows(after, t, "input-1", F.lit("2024-01-01T00:00:00Z")).write.json(path)
    rows = tables.read_checkpoint(spark, path)
    return rebalance.replay_checkpoint(views.pool(spark, d), rows, "input-1").select("word_id", "level", "processed")


@query(_ONE + "SELECT count(DISTINCT batch) AS batches, count(batch) AS processed, count(*) FILTER (level <> previous_level) AS switched FROM s1")
def rebalance_resume_stats(spark: SparkSession, d: str) -> DataFrame:
    t, after = _one(spark, d)
    return rebalance.resume_stats(rebalance.checkpoint_rows(after, t, "input-1", F.lit("2024-01-01T00:00:00Z")))


@query(
    _ONE + """SELECT batch, CAST(max(target) AS INT) AS target, count(*) AS size, (SELECT count(*) FROM s1 WHERE batch IS NOT NULL) - sum(count(*)) OVER w AS remaining,
        (SELECT count(*) FROM pool WHERE level = 4) + sum(count(*) FILTER (level = 4) - count(*)) OVER w AS level4, (SELECT count(*) FROM pool WHERE level = 5) + sum(count(*) FILTER (level = 5)) OVER w AS level5,
        (SELECT count(*) FROM pool WHERE level = 1) AS level1
    FROM s1 WHERE batch IS NOT NULL GROUP BY batch WINDOW w AS (ORDER BY batch)"""
)
def rebalance_running(spark: SparkSession, d: str) -> DataFrame:
    """The distribution of levels after each batch."""
    t, after = _one(spark, d)
    level = lambda x: F.col("distribution")[str(x)].alias(f"level{x}")
    return rebalance.progress_rows(after, t).select("batch", "target", "size", "remaining", level(1), level(4), level(5))


_CHAINED = _START + ", ".join(_step_sql(a, b, low, to, 600, "(CAST(1 AS DOUBLE) / 3)") for a, b, low, to in (("s0", "s1", 2, 1), ("s1", "s2", 3, 2), ("s2", "s3", 4, 3)))


@query(_CHAINED + "SELECT word_id, level, done AS processed FROM s3")
def rebalance_default(spark: SparkSession, d: str) -> DataFrame:
    done = rebalance.rebalance(views.pool(spark, d), parse_transitions("2:1,3:2,4:3"))
    return done.select("word_id", "level", "processed")


@query(_CHAINED + ", f AS (SELECT CAST(x AS INT) AS level FROM unnest(range(1, 6)) AS r(x)) SELECT f.level, count(word_id) AS n FROM f LEFT JOIN s3 USING (level) GROUP BY 1")
def rebalance_histogram(spark: SparkSession, d: str) -> DataFrame:
    return distribution.histogram(rebalance_default(spark, d), "level")


_PAIR = f"""WITH RECURSIVE pool AS (SELECT o_orderkey AS word_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS level, o_totalprice AS score FROM orders),
n AS (SELECT count(*) FILTER (level = 2) AS n2, count(*) FILTER (level = 3) AS n3 FROM pool),
q AS (SELECT *, n2 + n3 AS total FROM n),
b AS (
    SELECT CAST(-1 AS BIGINT) AS batch, CAST(0 AS BIGINT) AS from2, CAST(0 AS BIGINT) AS from3, CAST(0 AS BIGINT) AS s2, CAST(0 AS BIGINT) AS s3, CAST(0 AS BIGINT) AS size FROM q
    UNION ALL
    SELECT batch, from2, from3, s2, size - s2, size FROM (
        SELECT *, CASE WHEN size - q2 > n3 - from3 THEN size - (n3 - from3) ELSE least(q2, n2 - from2) END AS s2 FROM (
            SELECT *, floor(size * (n2 / CAST(total AS DOUBLE)))::BIGINT + CASE
                WHEN floor(size * (n2 / CAST(total AS DOUBLE))) + floor(size * (n3 / CAST(total AS DOUBLE))) < size
                     AND size * (n2 / CAST(total AS DOUBLE)) - floor(size * (n2 / CAST(total AS DOUBLE))) >= size * (n3 / CAST(total AS DOUBLE)) - floor(size * (n3 / CAST(total AS DOUBLE))) THEN 1 ELSE 0 END AS q2
            FROM (SELECT batch + 1 AS batch, from2 + s2 AS from2, from3 + s3 AS from3, least(600, total - from2 - s2 - from3 - s3) AS size, n2, n3, total FROM b, q WHERE from2 + s2 + from3 + s3 < total)))),
r AS (SELECT word_id, score, level, row_number() OVER (PARTITION BY level ORDER BY {_KEY}, word_id) AS rank FROM pool WHERE level IN (2, 3)),
p AS (
    SELECT r.*, batch, CAST(round_even((batch * 600 + size) * CAST(0.4 AS DOUBLE), 0) - round_even(batch * 600 * CAST(0.4 AS DOUBLE), 0) AS INT) AS target, size
    FROM r JOIN b ON CASE WHEN level = 2 THEN rank > from2 AND rank <= from2 + s2 ELSE rank > from3 AND rank <= from3 + s3 END),
o AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY score, word_id) <= size - target AS is_common FROM p),
pair AS (SELECT pool.word_id, CASE WHEN o.word_id IS NULL THEN pool.level WHEN o.is_common THEN 2 ELSE 3 END AS level, o.batch, o.target, o.is_common, CASE WHEN o.word_id IS NOT NULL THEN pool.level END AS previous_level
         FROM pool LEFT JOIN o USING (word_id))
"""


@query(_PAIR + "SELECT * FROM pair")
def rebalance_pair(spark: SparkSession, d: str) -> DataFrame:
    """A pair of levels in stratified batches."""
    t = parse_transition("2-3:3")
    after = rebalance.apply_transition(views.pool(spark, d).withColumn("processed", F.lit(False)), t, ratio=0.4)
    return after.select("word_id", "level", "batch", "target", "is_common", "previous_level")


@query(_PAIR + "SELECT batch, '[' || string_agg(previous_level || ':' || n, ' ' ORDER BY previous_level) || ']' AS mix FROM (SELECT batch, previous_level, count(*) AS n FROM pair WHERE batch IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def rebalance_mix(spark: SparkSession, d: str) -> DataFrame:
    return rebalance.source_mix(rebalance_pair(spark, d))


@query("SELECT level, CAST(n AS BIGINT) AS n FROM (SELECT 1 AS level, t // 40 AS n FROM (SELECT count(*) AS t FROM pool) UNION ALL SELECT 2, t // 14 FROM (SELECT count(*) AS t FROM pool) UNION ALL SELECT 3, t // 7 FROM (SELECT count(*) AS t FROM pool) UNION ALL SELECT 4, t - t // 40 - t // 14 - t // 7 - t // 4 FROM (SELECT count(*) AS t FROM pool) UNION ALL SELECT 5, t // 4 FROM (SELECT count(*) AS t FROM pool))")
def chain_histogram(spark: SparkSession, d: str) -> DataFrame:
    """The chain meets its targets, here in proportion to the words there are."""
    words = views.pool(spark, d)
    n = words.count()
    done = chain.run_chain(words, targets={1: n // 40, 2: n // 14, 3: n // 7, 5: n // 4}, cut=lambda df, step: written(df))
    return distribution.histogram(done, "level")


@query("SELECT word_id, word, type, CAST(CASE WHEN run_a.rarity_level IS NULL THEN 4 ELSE 3 END AS INT) AS final_level, CASE WHEN run_a.rarity_level IS NULL THEN '' ELSE 'r' END AS rebalance_rule, CASE WHEN run_a.rarity_level IS NULL THEN '' ELSE 'm' END AS rebalance_model, CASE WHEN run_a.rarity_level IS NULL THEN '' ELSE 'run' END AS rebalance_run, CASE WHEN run_a.rarity_level IS NULL THEN '' ELSE 't' END AS rebalanced_at FROM base LEFT JOIN run_a USING (word_id)")
def rebalance_output(spark: SparkSession, d: str) -> DataFrame:
    rule = F.when(F.col("rarity_level").isNull(), "").otherwise("r")
    after = views.base(spark, d).join(views.run(spark, d, 0), "word_id", "left").select("word_id", F.when(F.col("rarity_level").isNull(), 4).otherwise(3).alias("level"), rule.alias("rule"))
    return rebalance.rebalanced_output(views.base(spark, d), after, model="m", run="run", at=F.lit("t"))


# Scoring and answers ------------------------------------------------------------------------------------------------


def fixed_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    """Levels by id; it fails for large batches and is silent on every seventh word, as models are."""
    if len(batch) > 25:
        raise ValueError("Missing content")
    known = batch[batch["word_id"] % 7 != 3]
    return pd.DataFrame({"word_id": known["word_id"], "rarity_level": known["word_id"] % 5 + 1, "tag": "fixed", "confidence": 0.75})


@query("SELECT word_id, word, type, CAST(CASE WHEN word_id % 7 <> 3 THEN word_id % 5 + 1 END AS INT) AS rarity_level FROM base WHERE word_id NOT IN (SELECT word_id FROM run_a)")
def score_pending(spark: SparkSession, d: str) -> DataFrame:
    pending = retry.pending_words(views.base(spark, d), views.run(spark, d, 0))
    return scoring.score_words(pending, fixed_scorer).select("word_id", "word", "type", "rarity_level")


@query("SELECT event_id, '[{\"word_id\": ' || event_id || ', \"rarity_level\": ' || (event_id % 5 + 1) || ', \"confidence\": 1.0}]' AS repaired, 'repaired' AS stage FROM events")
def json_repair(spark: SparkSession, d: str) -> DataFrame:
    """Arrays damaged by a comment, a bare decimal, surplus commas and a missing end, as they were."""
    e = F.col("event_id").cast("string")
    damaged = F.concat(F.lit('[{"word_id": '), e, F.lit(', "rarity_level": '), (F.col("event_id") % 5 + 1).cast("string"), F.lit(', // level\n"confidence": 1.,,'))
    parsed = repair.parse_content_udf(damaged)
    return dealt(views.table(spark, d, "events").select("event_id")).select("event_id", parsed.alias("p")).select("event_id", F.col("p.node").alias("repaired"), F.col("p.stage").alias("stage"))


_LEVEL = "CAST(word_id % 5 + 1 AS INT)"


#: Words that are unlike each other, so that a misspelt one is like its own alone.
_UNLIKE = "substr(sha256(CAST(word_id AS VARCHAR)), 1, 16)"


def _answered(spark, d, unlike: bool = False) -> tuple[DataFrame, DataFrame]:
    """Batches by segment and key, with answers: a third by id, a third by word, a third misspelt."""
    words = views.base(spark, d).withColumn("batch", F.floor(F.col("word_id") / 25))
    words = words.withColumn("word", F.substring(F.sha2(F.col("word_id").cast("string"), 256), 1, 16)) if unlike else words
    third = F.col("word_id") % 3
    node = F.struct(
        F.when(third == 0, F.col("word_id")).alias("word_id"),
        F.when(third == 2, F.concat(F.lit("x"), "word")).otherwise(F.col("word")).alias("word"), "type", (F.col("word_id") % 5 + 1).alias("rarity_level"), F.lit("t").alias("tag"), F.lit(0.5).alias("confidence"),
    )
    whole = words.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("word_id", "word", "type"))).alias("words"), F.array_sort(F.collect_list(F.struct("word_id", node.alias("n")))).alias("nodes"))
    return words, whole.select("batch", "words", F.to_json(F.transform("nodes", lambda x: x["n"])).alias("response"))


@query(f"SELECT word_id, word, type, {_LEVEL} AS rarity_level FROM base WHERE word_id % 3 = 0")
def answers_by_id(spark: SparkSession, d: str) -> DataFrame:
    words, answers = _answered(spark, d)
    results = responses.valid_results(answers.withColumn("nodes", responses.result_nodes(F.col("response"))))
    return responses.match_by_id(words, results).select("word_id", "word", "type", "rarity_level")


@query(f"SELECT word_id, word, type, {_LEVEL} AS rarity_level FROM base WHERE word_id % 3 <> 2")
def answers_by_word(spark: SparkSession, d: str) -> DataFrame:
    words, answers = _answered(spark, d)
    results = responses.valid_results(answers.withColumn("nodes", responses.result_nodes(F.col("response"))))
    return responses.match_by_word(words, results).select("word_id", "word", "type", "rarity_level")


@query(f"SELECT word_id, {_UNLIKE} AS word, type, {_LEVEL} AS rarity_level FROM base")
def answers_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    words, answers = _answered(spark, d, unlike=True)
    results = responses.valid_results(answers.withColumn("nodes", responses.result_nodes(F.col("response"))))
    return responses.match_fuzzy(words, results).select("word_id", "word", "type", "rarity_level")


@query(
    f""", w AS (SELECT *, word_id // 25 AS batch, {_LEVEL} AS rarity_level, row_number() OVER (PARTITION BY word_id // 25 ORDER BY word_id) - 1 AS pos FROM base),
    r AS (SELECT batch, pos, type, rarity_level, CASE WHEN word_id % 3 = 2 THEN 'x' || word ELSE word END AS word FROM w),
    p AS (
        SELECT r.batch, r.pos, r.rarity_level, min(w.word_id) AS word_id FROM w JOIN r USING (batch, type)
        WHERE abs(len(w.word) - len(r.word)) <= 2 AND levenshtein(lower(w.word), lower(r.word)) <= 2 GROUP BY 1, 2, 3)
    SELECT word_id, rarity_level FROM p QUALIFY row_number() OVER (PARTITION BY word_id ORDER BY pos) = 1"""
)
def answers_fuzzy_ties(spark: SparkSession, d: str) -> DataFrame:
    """Words that are alike: a result fits several, and takes the first; a word that several take has the first's level."""
    words, answers = _answered(spark, d)
    results = responses.valid_results(answers.withColumn("nodes", responses.result_nodes(F.col("response"))))
    return responses.match_fuzzy(words, results).select("word_id", "rarity_level")


@query(f"SELECT word_id, {_LEVEL} AS rarity_level, ['id', 'word', 'fuzzy'][1 + word_id % 3] AS matched FROM base")
def answers_waterfall(spark: SparkSession, d: str) -> DataFrame:
    """Every word gets an answer of its batch: by id, by word, or by spelling."""
    return responses.parse_batches(_answered(spark, d, unlike=True)[1]).select("word_id", "rarity_level", "matched")


@query(
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[{"word_id": ' || event_id || ', "rarity_level": 2}]' ELSE '[{"word_id": ' || event_id || '}, {"word_id": 7}]' END AS saved,
    CASE WHEN event_id % 2 = 0 THEN 'block' ELSE 'salvaged' END AS stage FROM events"""
)
def json_block_and_salvage(spark: SparkSession, d: str) -> DataFrame:
    """An array inside prose, and one of which an object is beyond repair."""
    e = F.col("event_id").cast("string")
    prose = F.concat(F.lit('Sure, here: [{"word_id": '), e, F.lit(', "rarity_level": 2}] as asked.'))
    broken = F.concat(F.lit('[{"word_id": '), e, F.lit('}, {"word_id": :}, {"word_id": 7}]'))
    parsed = repair.parse_content_udf(F.when(F.col("event_id") % 2 == 0, prose).otherwise(broken))
    return views.table(spark, d, "events").select("event_id", parsed.alias("p")).select("event_id", F.col("p.node").alias("saved"), F.col("p.stage").alias("stage"))


@query("SELECT p_partkey AS batch, '1,' || (p_size + 1) AS picks, 1 AS surplus, 1 AS invalid FROM part")
def select_ids(spark: SparkSession, d: str) -> DataFrame:
    """One id twice, one out of range, one too many: the first two valid ones are picked."""
    n = (F.col("p_size") + 1).cast("string")
    answers = views.table(spark, d, "part").select(
        F.col("p_partkey").alias("batch"), (F.col("p_size") + 2).alias("size"), F.lit(2).alias("expected"), F.concat(F.lit("[1, 1, 0, "), n, F.lit(", "), (F.col("p_size") + 2).cast("string"), F.lit("]")).alias("response")
    )
    return responses.select_local_ids(answers).select("batch", F.array_join(F.col("picks").cast("array<string>"), ",").alias("picks"), "surplus", "invalid")


@query("SELECT word_id, word, CAST(row_number() OVER (PARTITION BY word_id // 25 ORDER BY word_id) AS INT) AS local_id FROM base")
def local_ids(spark: SparkSession, d: str) -> DataFrame:
    return scoring.numbered(views.base(spark, d).withColumn("batch", F.floor(F.col("word_id") / 25)), "batch", "word_id").select("word_id", "word", "local_id")


# Files --------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id AS word_id, sha256(coalesce(text, '')) AS word, coalesce(lang, '') AS type FROM documents")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Texts with quotes and line feeds, written as CSV and read back."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(views.table(spark, d, "documents").select(F.col("doc_id").alias("word_id"), F.col("text").alias("word"), F.col("lang").alias("type")), path)
    rows = tables.read_csv(spark, path)
    return rows.select(tables.strict("long", "word_id", path).alias("word_id"), F.sha2("word", 256).alias("word"), "type")


@query("SELECT doc_id AS word_id, 'w' || doc_id AS word, coalesce(lang, 'x') AS type FROM documents")
def base_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "base")
    docs = views.table(spark, d, "documents")
    sinks.write_csv(docs.select(F.col("doc_id").alias("word_id"), F.concat(F.lit("w"), "doc_id").alias("word"), F.coalesce("lang", F.lit("x")).alias("type")), path)
    return tables.read_base(spark, path)


@query("SELECT word_id, rarity_level, confidence, 'm' AS model FROM (SELECT * FROM run_log QUALIFY row_number() OVER (PARTITION BY word_id ORDER BY seq DESC) = 1)")
def run_scan(spark: SparkSession, d: str) -> DataFrame:
    """A run's rows appended twice, each time all that there are so far, written in order and read: the last of each word counts."""
    log, path = scratch_path(spark, "log"), scratch_path(spark, "run")
    rows = views.run_log(spark, d).withColumns({"word": F.concat(F.lit("w"), F.col("word_id").cast("string")), "type": F.lit("N"), "model": F.lit("m")})
    sinks.append_run(rows.where("seq % 2 = 0").drop("run"), log, 0)
    sinks.append_run(rows.where("seq % 2 = 1").drop("run"), log, 1)
    order = spark.read.parquet(log).join(rows.select("word_id", "confidence", "rarity_level", F.col("seq").alias("at")), ["word_id", "confidence", "rarity_level"]).groupBy("at").agg(*[F.first(c).alias(c) for c in ("word_id", "word", "type", "rarity_level", "confidence", "model")])
    sinks.write_csv(order.orderBy("at").drop("at"), path)
    return tables.read_run(spark, path).select("word_id", "rarity_level", "confidence", "model")


@query("SELECT doc_id AS word_id, 1 AS predicted_level, CASE WHEN toxic = 1 THEN 'undecided' WHEN quality = 1 THEN '1' ELSE 'unknown_4_5' END AS label FROM labels")
def review_label_scan(spark: SparkSession, d: str) -> DataFrame:
    """Labels appended as a reviewer's, and read back."""
    path = scratch_path(spark, "labels")
    rows = views.review_labels(spark, d).withColumn("predicted_confidence", F.lit(0.25))
    sinks.append_labels(rows, path)
    return tables.read_review_labels(spark, path)


@query("SELECT word_id, word, type, rarity_level, 't' AS tag, confidence, 'now' AS scored_at, 'm' AS model, 'r' AS run_slug FROM run_a JOIN base USING (word_id)")
def run_rows(spark: SparkSession, d: str) -> DataFrame:
    scored = views.base(spark, d).join(views.run(spark, d, 0).select("word_id", "rarity_level", "confidence"), "word_id", "left").withColumn("tag", F.lit("t"))
    return scoring.run_rows(scored, model="m", run="r", at=F.lit("now"))


@query("SELECT word_id, CAST(rarity_level AS INT) AS level FROM run_log QUALIFY row_number() OVER (PARTITION BY word_id ORDER BY seq DESC) = 1")
def final_level_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files of all labels in order: the last of each word counts, of final_level before rarity_level."""
    path = scratch_path(spark, "levels")
    rows = views.run_log(spark, d).select("word_id", F.col("rarity_level").alias("final_level"), F.lit(5).alias("rarity_level"), "seq")
    sinks.write_csv(rows.orderBy("seq").drop("seq"), path)
    return tables.read_final_levels(spark, path)


@query("SELECT word_id, rarity_level, seq FROM (SELECT * FROM run_log QUALIFY row_number() OVER (PARTITION BY word_id ORDER BY seq DESC) = 1)")
def run_log_stream(spark: SparkSession, d: str) -> DataFrame:
    """The log as a stream of appended files, merged to the latest label of each word."""
    from ..schemas import RUN
    from ..sources.versions import VersionedTable
    from ..streaming.run_log import follow_run_log

    log, table, marks = (scratch_path(spark, x) for x in ("log", "latest", "marks"))
    rows = views.run_log(spark, d).select("word_id", "rarity_level", "confidence", "seq")
    blank = {f.name: F.lit("").cast(f.dataType) for f in RUN.fields if f.name not in rows.columns}
    rows.withColumns(blank).write.parquet(log)
    follow_run_log(spark, log, table, marks).awaitTermination()
    return VersionedTable(spark, table).read().select("word_id", "rarity_level", "seq")
