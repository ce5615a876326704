"""Command line: python -m lexirank.cli COMMAND."""

from __future__ import annotations

import argparse
import functools
import hashlib
import json
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.scalars import run_slug
from .operators import audit, compare, counters, distribution, metrics, rebalance, retry, review, scoring, upload
from .operators.dedup import guarded_rewrite
from .operators.endpoint import ChatScorer, ChatSelector, detect, preflight
from .operators.journal import Journal
from .operators.selection import picker
from .plans import chain
from .schemas import level_column
from .sources import sinks, tables
from .sources.uploads import Database, upload_words
from .transitions import DEFAULT_TRANSITIONS, Transition, check_disjoint, parse_transition, parse_transitions


def now():
    """The time in UTC, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _session() -> SparkSession:
    return SparkSession.builder.appName("lexirank").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def export(spark, o) -> int:
    rows = tables.read_words_table(spark, tables.database_options())
    sinks.write_csv(rows.orderBy("word_id"), o.output_csv)
    return 0


def _chat(o, kind, system: str, template: str):
    endpoint = detect(o.endpoint, o.base_url)
    if not o.skip_preflight:
        for warning in preflight(endpoint, o.model):
            print(f"warning: {warning}")
    log = Journal(f"{o.output_dir}/requests/{uuid.uuid4().hex}") if o.log_requests else None
    return kind(endpoint, o.model, Path(system).read_text("utf-8"), Path(template).read_text("utf-8"), o.max_tokens, o.timeout_seconds, log=log)


def score(spark, o) -> int:
    run = spark.range(1).select(run_slug(F.lit(o.run)).alias("s")).first()["s"]
    state = f"{o.output_dir}/runs/{run}.state.json"
    journal = Journal(f"{o.output_dir}/runs/{run}.journal")
    with sinks.output_lock(f"{o.output_dir}/runs/{run}"):
        sinks.write_state(state, {"run": run, "status": "running"})
        try:
            sinks.recover(spark, o.output_csv)
            base = tables.read_base(spark, o.input or o.base_csv)
            done = tables.read_run(spark, o.output_csv)
            before = done.count()
            kept = journal.table(spark, scoring.SCORED).filter("rarity_level is not null").dropDuplicates(["word_id"])  # of a run that ended early
            found = kept.count()
            pending = retry.pending_words(base, done, force=o.force, most=o.limit or 0).join(kept.select("word_id"), "word_id", "left_anti")
            scorer = _chat(o, ChatScorer, o.system_prompt_file, o.user_template_file)
            scored = scoring.score_words(pending, scorer, batch_size=o.batch_size, retry=scoring.Retry(o.max_retries), journal=journal, slots=o.slots)
            log = f"{o.output_dir}/runs/{run}-{uuid.uuid4().hex}"
            started = time.monotonic()
            scored, counts = counters.counted(scored, counters.scoring())
            scored.unionByName(kept).write.parquet(log)
            if error := journal.tripped():
                raise scoring.Unreachable(f"{error}: what was answered is kept, the next run goes on from there")
            scored, seen = spark.read.parquet(log), counts()
            rows = scoring.run_rows(scored, model=o.model, run=run, at=now())
            failed = scoring.failed_rows(scored, run=run, at=now())
            sinks.append_json(failed, f"{o.output_dir}/failed_batches/{run}.failed.jsonl")
            sinks.write_csv(guarded_rewrite(done, rows) if before else rows.orderBy("word_id"), o.output_csv)
            journal.clear()
            n, bad = seen["scored"] + found, seen["failed"]
            sinks.write_state(state, {"run": run, "status": "completed", "scored": n, "failed": bad, "pending": bad, "counters": seen})
            asked = spark.range(1).select(*[F.lit(v).alias(k) for k, v in (("scored", seen["scored"]), ("failed", bad), ("successful", seen["scored"]), ("batches", seen["scored"] + bad))])
            print(metrics.progress_text(asked, F.lit(bad), F.lit(time.monotonic() - started), F.lit(o.batch_size)).first()[0])
            print(f"scored={n} failed={bad} resumed={found}")
            return 0
        except BaseException as x:
            sinks.write_state(state, {"run": run, "status": "failed", "error": str(x)[:500]})
            raise


def compare_(spark, o) -> int:
    runs = [tables.read_run(spark, p, missing_is_empty=False) for p in (o.run_a_csv, o.run_b_csv, o.run_c_csv) if p]
    strategy = o.merge_strategy.strip().lower().replace("-", "_")
    found = compare.compare_runs(tables.read_base(spark, o.base_csv), *runs, strategy=strategy, spread_limit=o.outlier_threshold, confidence_limit=o.confidence_threshold)
    sinks.write_csv(found.orderBy("word_id"), o.output_csv)
    sinks.write_csv(compare.outliers(found).orderBy("word_id"), o.outliers_csv)
    return 0


def _connect(options: dict[str, str]):
    import psycopg

    return psycopg.connect(options["url"], user=options.get("user"), password=options.get("password"))


def _database(options: dict[str, str]) -> Database:
    return Database(functools.partial(_connect, options))


def upload_(spark, o) -> int:
    """The plan is written before the database changes: it is what is uploaded and what is reported, by a run that takes up a stopped one too."""
    options = tables.database_options()
    final = tables.read_final_levels(spark, o.final_csv)
    db = tables.read_words_table(spark, options, ("id", "rarity_level"))
    pending = f"{o.output_dir}/upload.pending.json"
    with sinks.output_lock(f"{o.output_dir}/upload"):
        state = json.loads(Path(pending).read_text("utf-8")) if Path(pending).exists() else {}
        asked = {"final_csv": o.final_csv, "mode": upload.parse_mode(o.mode), "report_csv": o.report_csv}
        if state and {k: state[k] for k in asked} != asked:
            raise ValueError(f"an upload of {state['final_csv']} was stopped: run it again, or delete {pending}")
        if not state:
            staged = sinks.stage_csv(upload.upload_report(final, db, o.mode).orderBy("word_id"), o.report_csv)
            state = asked | {"token": o.upload_batch_id or uuid.uuid4().hex, "staged": staged}
            sinks.write_state(pending, state)
        if tables.exists(spark, state["staged"]):
            plan = tables.read_csv(spark, state["staged"])
            plan = plan.withColumns({"word_id": F.col("word_id").cast("long"), "new_level": F.when(F.col("new_level") != "", F.col("new_level")).cast("int")})
            n = upload_words(upload.upload_updates(plan), _database(options), state["token"])
            sinks.replace(spark, state["staged"], o.report_csv)
            print(f"updated={n}")
        status, marks = upload.upload_status(final, db), {"uploaded_at": now(), "batch_id": state["token"]}
        if not status.isEmpty():
            candidate = tables.read_csv(spark, o.final_csv)
            try:
                sinks.write_csv(upload.mark_uploaded(candidate, status, **marks), o.final_csv)
            except PermissionError:
                sinks.write_csv(upload.companion_markers(candidate, status, **marks), f"{o.final_csv}.upload_markers.csv")
        Path(pending).unlink()
    return 0


def _transitions(o) -> list[Transition]:
    if o.from_level is None and o.to_level is None:
        return parse_transitions(o.transitions)
    if o.from_level is None or o.to_level is None:
        raise ValueError("--from-level and --to-level go together")
    source = f"{o.from_level}-{o.from_level_high}" if o.from_level_high is not None else str(o.from_level)
    return [parse_transition(f"{source}:{o.to_level}")]


def _fingerprint(words, *settings) -> str:
    """Of the words' ids and levels, whatever their order, and of what decides batches and picks."""
    n, total = words.agg(F.count(F.lit(1)), F.sum(F.xxhash64("word_id", "level").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((n, str(total), *settings)).encode()).hexdigest()[:16]


def _pick(o, picks: str):
    """What picks a batch's commonest words: None for the score column, else the model, with a journal in which it finds its earlier answers."""
    if o.pick == "score":
        return None
    return picker(_chat(o, ChatSelector, o.select_system_file, o.select_template_file), retry=scoring.Retry(o.max_retries), journal=Journal(picks))


def rebalance_(spark, o) -> int:
    run, at = o.run, sinks.layout(o.output_dir)
    with sinks.output_lock(o.output_csv):
        ordered = tables.read_levels_table(spark, o.input_csv, in_order=True)
        table = ordered.drop("seq")
        score = F.col(o.score_column).cast("double") if o.score_column in table.columns else F.lit(0.0)
        words = ordered.select("word_id", "word", "level", score.alias("score"), F.col("seq").alias("_seq")).groupBy("word_id")
        words = words.agg(*[F.max_by(c, "_seq").alias(c) for c in ("word", "level", "score")])  # of an id's rows the last counts
        found = _transitions(o)
        check_disjoint(found)
        print_of = _fingerprint(words, [t.text for t in found], o.lower_ratio, o.batch_size, o.seed or 0, o.pick, o.model)
        root = f"{at['rebalance/runs']}/{run}-{uuid.uuid4().hex}"
        model = o.model if o.pick == "model" else ""
        kept = ("batch", "target", "is_common", "previous_level", "rule")
        # Transitions that a run with the same words and settings completed are taken from its checkpoint; the others follow.
        start = words.withColumn("processed", F.lit(False))
        log = f"{at['rebalance/checkpoints']}/{run}.jsonl"
        ended = tables.read_checkpoint(spark, log)
        there, counts = rebalance.checkpoint_batches(ended, print_of), rebalance.level_counts(start)
        complete = [t.text for t in found if 0 < there.get(t.text, 0) == rebalance.batches_of(counts, t, o.batch_size)]
        done, marks = start, None
        if complete:
            rows = ended.where(F.col("transition").isin(*complete))
            rebalance.replay_checkpoint(start, rows, print_of).write.parquet(f"{root}/0")
            rebalance.checkpoint_rules(rows, print_of).write.parquet(f"{root}/rules")
            done, marks = spark.read.parquet(f"{root}/0"), spark.read.parquet(f"{root}/rules")
            print(f"resumed: {', '.join(complete)}")
        for n, t in enumerate(found, 1):
            if t.text in complete:
                continue
            picks, key = f"{at['rebalance/checkpoints']}/{run}/{print_of}/{n}", f"{print_of}-{n}"
            after = rebalance.apply_transition(done, t, ratio=o.lower_ratio, batch_size=o.batch_size, seed=o.seed or 0, pick=_pick(o, picks))
            after, sums = counters.counted(after, counters.transitions())
            after.write.parquet(f"{root}/{n}")
            after, sums = spark.read.parquet(f"{root}/{n}"), sums()
            stamp = {"timestamp": now(), "run_slug": F.lit(run), "model": F.lit(model)}
            sinks.append_json(rebalance.switched_events(after, t).withColumns(stamp), f"{at['rebalance/switched_words']}/{run}.jsonl", key)
            sinks.append_json(rebalance.progress_rows(after, t), f"{at['rebalance/progress']}/{run}.jsonl", key)
            rows = rebalance.checkpoint_rows(after, t, print_of, now())
            sinks.append_json(rows, log, key)  # the last: with it the transition is complete
            stats = rebalance.resume_stats(rows).first()
            print(f"{t.text}: batches={stats.batches} eligible={sums['eligible']} common={sums['common']} switched={sums['switched']}")
            taken = after.where("batch is not null").select("word_id", "rule")
            marks = taken if marks is None else marks.unionByName(taken)
            done = after.drop(*kept)
        after = done.join(marks, "word_id", "left").withColumn("rule", F.coalesce("rule", F.lit("")))
        out = rebalance.rebalanced_output(table.drop("level"), after, model=model, run=run, at=now())
        sinks.write_csv(out.orderBy("word_id"), o.output_csv)
    return 0


def audit_(spark, o) -> int:
    candidate = tables.read_levels_table(spark, o.candidate_csv)
    reference = tables.read_levels_table(spark, o.reference_csv) if o.reference_csv else None
    anchors = tables.read_anchors(spark, o.anchor_l1_file) if o.anchor_l1_file else None
    limits = {k: v for k, v in (("min_jaccard", o.min_l1_jaccard), ("min_precision", o.min_anchor_l1_precision), ("min_recall", o.min_anchor_l1_recall)) if v is not None}
    got = audit.quality_audit(candidate, "level", reference, "level", anchors, **({"min_jaccard": 0.0, "min_precision": 0.0, "min_recall": 0.0} | limits)).first()
    print(distribution.distribution_text(distribution.rarity_distribution(candidate, "level")).first()[0])
    print(f"l1_jaccard={got.l1_jaccard} anchor_precision={got.anchor_precision} anchor_recall={got.anchor_recall} failures={got.failures}")
    return int(not got.passed)


def dist(spark, o) -> int:
    rows = tables.read_csv(spark, o.csv)
    for r in distribution.rarity_distribution(rows, level_column(rows, o.level_column)).orderBy("level").collect():
        print(f"{r.level}: {r.n} ({r.pct:.1f}%)")
    return 0


def review_(spark, o) -> int:
    rows = tables.read_csv(spark, o.csv)
    level = level_column(rows, o.level_column)
    typed = rows.withColumns({"word_id": tables.strict("long", "word_id", o.csv), level: tables.checked_level(level, o.csv)})
    if o.confidence_column in rows.columns and o.confidence_column != "confidence":
        typed = typed.withColumn("confidence", F.col(o.confidence_column))
    items = review.review_items(typed, level, review.parse_only_levels(o.only_levels))
    queue = review.review_queue(items, tables.read_review_labels(spark, o.labels_csv), include_undecided=o.include_undecided, most=o.max_items)
    sinks.write_csv(queue, f"{o.labels_csv}.queue")
    print(f"queue_size={queue.count()}: label its rows into {o.labels_csv}")
    return 0


def review_check(spark, o) -> int:
    limits = {k: v for k, v in (("min_precision", o.min_precision), ("min_reviewed", o.min_reviewed)) if v is not None}
    got = review.review_gate(tables.read_review_labels(spark, o.labels_csv), **limits).first()
    print(f"reviewed={got.reviewed} accepted={got.accepted} precision={got.precision:.4f} passed={got.passed}")
    return int(not got.passed)


def retry_(spark, o) -> int:
    rows = tables.read_csv(spark, o.base_csv)
    found = retry.retry_input(rows.withColumn("_key", tables.strict("long", "word_id", o.base_csv)), retry.failed_ids(tables.read_lines(spark, o.failed_jsonl)), "_key").drop("_key")
    sinks.write_csv(found, o.output_csv)
    print(f"rows={found.count()}")
    return 0


def chain_(spark, o) -> int:
    state = o.state_file or f"{o.runs_dir}/{o.run_base}.state.tsv"
    first, source = 1, o.input_csv
    if o.resume and Path(state).exists():
        s = sinks.read_tsv_state(state)
        first, source = int(s["last_completed_step"]) + 1, s["current_csv"]
    elif o.resume:
        for n in range(1, len(chain.STEPS) + 1):
            if not tables.exists(spark, f"{o.runs_dir}/{o.run_base}_step{n}.csv"):
                break
            first, source = n + 1, f"{o.runs_dir}/{o.run_base}_step{n}.csv"
    rows = tables.read_levels_table(spark, source)
    names = rows.columns

    def cut(df, step):
        path = f"{o.runs_dir}/{o.run_base}_step{step}.csv"
        sinks.write_csv(df.withColumn("final_level", F.col("level")).drop("level", "score"), path)
        sinks.write_tsv_state(state, {"last_completed_step": str(step), "current_csv": path, "run_base": o.run_base, "model": o.model})
        return tables.read_levels_table(spark, path).withColumn("score", score)

    score = F.col("confidence").cast("double") if "confidence" in names else F.lit(0.0)
    picks = lambda df, step: _pick(o, f"{o.runs_dir}/{o.run_base}.picks/{step}-{_fingerprint(df, chain.STEPS[step - 1], o.batch_size, o.model)}")
    done = chain.run_chain(rows.withColumn("score", score), first=first, cut=cut, batch_size=o.batch_size, picks=picks)
    if o.final_output_csv:
        sinks.write_csv(done.withColumn("final_level", F.col("level")).drop("level", "score"), o.final_output_csv)
    if o.reference_csv or o.anchor_l1_file:
        o.candidate_csv = o.final_output_csv or f"{o.runs_dir}/{o.run_base}_step{len(chain.STEPS)}.csv"
        return audit_(spark, o)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexirank")
    p.add_argument("--output-dir", default="build/rarity")
    sub = p.add_subparsers(dest="command", required=True)

    def command(names, run, *arguments):
        for name in names:
            c = sub.add_parser(name)
            c.set_defaults(run_command=run)
            for flag, options in arguments:
                c.add_argument(flag, **options)

    need, text = {"required": True}, {}
    flag = lambda default=False: {"action": argparse.BooleanOptionalAction, "default": default}
    number = lambda kind, default=None: {"type": kind, "default": default}
    default = lambda value: {"default": value}
    lm = [("--model", need), ("--endpoint", text), ("--base-url", text), ("--skip-preflight", flag()), ("--log-requests", flag()), ("--max-retries", number(int, 3)), ("--timeout-seconds", number(int, 300)), ("--max-tokens", number(int, 8000))]
    selects = [("--pick", {"choices": ("model", "score"), "default": "model"}), ("--select-system-file", default("prompts/select_system.txt")), ("--select-template-file", default("prompts/select_user.txt"))]
    prompts = [("--system-prompt-file", default("prompts/system.txt")), ("--user-template-file", default("prompts/user.txt"))]
    gates = [("--reference-csv", text), ("--anchor-l1-file", text), ("--min-l1-jaccard", number(float)), ("--min-anchor-l1-precision", number(float)), ("--min-anchor-l1-recall", number(float))]
    command(("step1-export", "step1"), export, ("--output-csv", need))
    command(("step2-score", "step2"), score, ("--run", need), ("--base-csv", need), ("--output-csv", need), ("--input", text), ("--batch-size", number(int, 50)), ("--limit", number(int)), ("--force", flag()), ("--slots", number(int)), *lm, *prompts)
    command(
        ("step3-compare", "step3"), compare_, ("--run-a-csv", need), ("--run-b-csv", need), ("--run-c-csv", text), ("--output-csv", need), ("--outliers-csv", default("build/rarity/step3_outliers.csv")),
        ("--base-csv", default("build/rarity/step1_words.csv")), ("--outlier-threshold", number(int, 2)), ("--confidence-threshold", number(float, 0.55)), ("--merge-strategy", default("median")),
    )
    command(("step4-upload", "step4"), upload_, ("--final-csv", need), ("--mode", default("partial")), ("--report-csv", default("build/rarity/step4_upload_report.csv")), ("--upload-batch-id", text))
    command(
        ("step5-rebalance", "step5"), rebalance_, ("--run", need), ("--input-csv", need), ("--output-csv", need), ("--batch-size", number(int, rebalance.BATCH_SIZE)), ("--lower-ratio", number(float, rebalance.RATIO)),
        ("--seed", number(int)), ("--from-level", number(int)), ("--from-level-high", number(int)), ("--to-level", number(int)), ("--transitions", default(DEFAULT_TRANSITIONS)), ("--score-column", default("confidence")), *lm, *selects,
    )
    command(("quality-audit",), audit_, ("--candidate-csv", need), *gates)
    command(("rarity-distribution", "dist"), dist, ("--csv", need), ("--level-column", text))
    command(
        ("review-low-confidence", "review"), review_, ("--csv", need), ("--labels-csv", default("build/rarity/review_labels.csv")), ("--level-column", text), ("--confidence-column", default("confidence")),
        ("--only-levels", text), ("--max-items", number(int, 200)), ("--include-undecided", flag()),
    )
    command(("l1-review-check",), review_check, ("--labels-csv", default("build/rarity/review_labels.csv")), ("--min-precision", number(float)), ("--min-reviewed", number(int)))
    command(("build-retry-input",), retry_, ("--failed-jsonl", need), ("--base-csv", need), ("--output-csv", need))
    command(
        ("chain-rebalance-target-dist",), chain_, ("--input-csv", need), *[x for x in lm if x[0] not in ("--model", "--max-retries", "--timeout-seconds", "--max-tokens")], *selects,
        ("--model", default("openai/gpt-oss-20b")), ("--max-retries", number(int, 2)), ("--timeout-seconds", number(int, 120)), ("--max-tokens", number(int, 1200)), ("--run-base", default("rb_run")), ("--runs-dir", default("build/rarity/runs")), ("--state-file", text),
        ("--resume", flag(True)), ("--final-output-csv", text), ("--batch-size", number(int, rebalance.BATCH_SIZE)), *gates,
    )
    return p


def main(argv: list[str] | None = None) -> int:
    options = parser().parse_args(argv)
    try:
        return options.run_command(_session(), options)
    except (ValueError, OSError) as x:
        print(f"error: {x}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
