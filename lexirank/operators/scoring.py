"""Scoring of pending words by a pluggable scorer, in batches on the executors."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import said
from .journal import Journal
from .metrics import HIGH_RATE, LOW_RATE, SUCCESS, WINDOW

#: From a batch (word_id, word, type) to its results (word_id, rarity_level, tag, confidence), for some or all of its words.
#: A task that runs again calls it again: it must give the same answer.
Scorer = Callable[[pd.DataFrame], pd.DataFrame]

# Defaults of a scoring run.
BATCH_SIZE, RETRIES, DEPTH = 50, 3, 10

SCORED = "word_id long, word string, type string, rarity_level int, tag string, confidence double, attempts int, matched string, error string"


@dataclass(frozen=True)
class Retry:
    """How often a batch is tried, how deep it is halved, and how long a crash makes it wait, by attempt."""

    attempts: int = RETRIES
    depth: int = DEPTH
    crash_wait: float = 10.0


class Unreachable(RuntimeError):
    """The scorer can't be reached: the run ends, what it wrote stays. done: SCORED rows of the batch that was under way."""

    def __init__(self, error: str, done: pd.DataFrame | None = None) -> None:
        super().__init__(error)
        self.done = done


def _scored(parts: list[pd.DataFrame]) -> pd.DataFrame:
    columns = [f.split()[0] for f in SCORED.split(", ")]
    parts = [x[columns].astype({"rarity_level": "Int32", "confidence": "Float64"}) for x in parts if len(x)]
    return pd.concat(parts) if parts else pd.DataFrame(columns=columns)


def resilient(scorer: Scorer, batch: pd.DataFrame, retry: Retry = Retry()) -> pd.DataFrame:
    """Results of a batch and, with a null level and an error, its unresolved words.

    A stack of work: a part that fails, or resolves some words only, is tried again for what is left, then in halves.
    A scorer that can't be reached at a part's last attempt ends it, whatever was resolved before.
    """
    work, done, failed = [(batch, 0)], [], []
    while work:
        part, depth = work.pop()
        error, left = "", part
        for attempt in range(1, retry.attempts + 1):
            try:
                found = scorer(left)
            except Exception as x:  # noqa: BLE001  a scorer may fail in any way
                error = str(x)
                if isinstance(x, (TimeoutError, ConnectionError)) or said(error, "unreachable"):
                    if attempt == retry.attempts:
                        raise Unreachable(error, _scored(done)) from x
                elif said(error, "crash"):
                    time.sleep(retry.crash_wait * attempt)
                continue
            valid = found[found["word_id"].isin(left["word_id"]) & found["rarity_level"].between(1, 5)].drop_duplicates("word_id")
            valid = valid if "matched" in valid else valid.assign(matched=None)
            if len(valid):
                done.append(left.merge(valid[["word_id", "rarity_level", "tag", "confidence", "matched"]], on="word_id").assign(attempts=attempt, error=None))
                left = left[~left["word_id"].isin(valid["word_id"])]
            if not len(left):
                break
            error = f"{len(left)} words unresolved"
        if len(left) > 1 and depth < retry.depth:
            half = len(left) // 2
            work += [(left.iloc[half:], depth + 1), (left.iloc[:half], depth + 1)]
        elif len(left):
            failed.append(left.assign(rarity_level=None, tag=None, confidence=None, attempts=retry.attempts, matched=None, error=error))
    return _scored([*done, *failed])


def next_size(size: int, last: list[bool], most: int, least: int = 3) -> int:
    """A batch size after the last outcomes, of which WINDOW are looked at: smaller where few succeed, larger where nearly all do."""
    rate = sum(last[-WINDOW:]) / len(last[-WINDOW:])
    return max(least, size * 2 // 3) if rate < LOW_RATE else min(most, size * 3 // 2) if rate > HIGH_RATE else size


def score_words(
    pending: DataFrame, scorer: Scorer, *, batch_size: int = BATCH_SIZE, retry: Retry = Retry(), journal: Journal | None = None, slots: int | None = None
) -> DataFrame:
    """SCORED rows of all pending words: each partition, a range of ids, feeds the scorer batch by batch.

    Partitions are what runs at once: with slots, at most so many calls. A partition's batches are of batch_size at
    first, smaller after failures. With a journal each batch's results are kept as they come: a task that runs again
    finds them and asks for none twice, and the words with a level that a run had before it ended are in the journal's table.
    A scorer that can't be reached trips the journal: the task that met it, and every other before its next batch,
    end without failing, their further words left out. Without a journal the run fails.
    """
    if batch_size < 5:
        raise ValueError("a batch has 5 words or more")
    if journal:
        journal.mend()
    plan = uuid.uuid4().hex

    def done(batch: pd.DataFrame) -> tuple[pd.DataFrame | None, bool]:
        """A batch's rows, and whether to go on."""
        if not journal:
            return resilient(scorer, batch, retry), True
        name = hashlib.sha256(",".join([plan, *map(str, batch["word_id"])]).encode()).hexdigest()[:32]
        kept = journal.get(name)
        if kept is not None:
            return _scored([pd.DataFrame(kept)]), True
        if journal.tripped():
            return None, False
        on = True
        try:
            out = resilient(scorer, batch, retry)
        except Unreachable as x:
            journal.trip(str(x))
            out, name, on = x.done, f"{name}-part", False
        if len(out):
            rows = out.astype(object).where(out.notna(), None).to_dict("records")
            journal.put(name, [{k: v.item() if hasattr(v, "item") else v for k, v in r.items()} for r in rows])
        return out, on

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, size, last, on = pd.DataFrame(columns=["word_id", "word", "type"]), batch_size, [], True
        try:
            for frame in frames:
                left = pd.concat([left, frame]) if len(left) else frame
                while on and len(left) >= size:
                    out, on = done(left.iloc[:size])
                    left = left.iloc[size:]
                    if on:
                        last = [*last[1 - WINDOW :], out["rarity_level"].notna().mean() >= SUCCESS]
                        size = next_size(size, last, batch_size)
                    if out is not None:
                        yield out
                left = left if on else left.iloc[:0]
            while on and len(left):
                out, on = done(left.iloc[:size])
                left = left.iloc[size:]
                if out is not None:
                    yield out
        finally:
            getattr(scorer, "flush", lambda: None)()

    rows = pending.select("word_id", "word", "type")
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartitionByRange(min(tasks, slots or tasks), "word_id").sortWithinPartitions("word_id").mapInPandas(run, SCORED)


def run_rows(scored: DataFrame, *, model: str, run: str, at: Column) -> DataFrame:
    """Rows of a run: the words that have a level."""
    rows = scored.where("rarity_level is not null").select("word_id", "word", "type", "rarity_level", "tag", "confidence")
    return rows.withColumns({"scored_at": at.cast("string"), "model": F.lit(model), "run_slug": F.lit(run)})


def failed_rows(scored: DataFrame, *, run: str, at: Column) -> DataFrame:
    rows = scored.where("rarity_level is null")
    return rows.select(at.cast("string").alias("ts"), F.lit(run).alias("run"), "word_id", "word", "type", "error")


def numbered(batch: DataFrame, batch_col: str, order: str) -> DataFrame:
    """Local ids 1 to N within a batch: all that a prompt tells of a word besides its spelling."""
    from pyspark.sql.window import Window

    return batch.withColumn("local_id", F.row_number().over(Window.partitionBy(batch_col).orderBy(order)))
