"""Metrics of a scoring run, from one row per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import duration_text, error_category

# A batch succeeds at this ratio; so many outcomes are looked at; below and above these rates sizes change.
SUCCESS, WINDOW, LOW_RATE, HIGH_RATE = 0.9, 10, 0.5, 0.9


def run_metrics(batches: DataFrame) -> DataFrame:
    """One row: batches, scored, failed, partial, successful of batch rows (scored, failed)."""
    some, none = F.col("scored") > 0, F.col("failed") == 0
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return batches.agg(
        F.count(F.lit(1)).alias("batches"), total("scored").alias("scored"), total("failed").alias("failed"), F.count_if(some & ~none).alias("partial"), F.count_if(none).alias("successful")
    )


def throughput(scored: Column, elapsed: Column) -> Column:
    """Words a minute; 0 in the first second."""
    return F.when(elapsed < 1, 0.0).otherwise(scored * 60.0 / elapsed)


def eta_seconds(remaining: Column, words_per_minute: Column) -> Column:
    return F.when(words_per_minute < 0.1, 0.0).otherwise(remaining / words_per_minute * 60.0)


def success_rate(successful: Column, batches: Column) -> Column:
    return F.when(batches > 0, successful / batches).otherwise(1.0)


def error_counts(messages: DataFrame, column: str = "error") -> DataFrame:
    """category and n, most frequent first."""
    return messages.groupBy(error_category(F.col(column)).alias("category")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category")


#: Positions of outcomes in a slice: what one row holds.
SLICE = 2_000


def possible_sizes(initial: int, least: int) -> list[int]:
    """All sizes that shrinking and growing lead to from the initial one."""
    found, work = {initial}, [initial]
    while work:
        size = work.pop()
        for new in (max(least, size * 2 // 3), min(initial, size * 3 // 2)):
            if new not in found:
                found.add(new)
                work.append(new)
    return sorted(found)


def batch_sizes(outcomes: DataFrame, key: str, order: str, ratio: str, initial: int, least: int = 3, slice_rows: int | None = None) -> DataFrame:
    """For each key the batch size after each outcome in order (i, size). order: whole numbers, one for each outcome of a key.

    Success is a ratio of 0.9 or more; of the last ten, under half shrinks the size by a third, over nine tenths
    grows it by half, between the least and the initial size. A key's outcomes are cut into slices: with the nine before
    it, what a slice does to a size is known for each of the few sizes there are; these maps are composed in order,
    which gives each slice its first size, and slices are gone through side by side. So one key of any length is split.
    """
    if least < 1 or initial < least:
        raise ValueError("sizes are at least 1, and the initial one at least the least")
    rows = outcomes.select(F.col(key).alias("_key"), F.col(order).alias("_o"), (F.col(ratio) >= SUCCESS).cast("int").alias("_ok"), F.floor(F.col(order) / (slice_rows or SLICE)).alias("_slice"))
    cut = rows.groupBy("_key", "_slice").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_ok"))), lambda x: x["_ok"]).alias("_oks"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(1 - WINDOW, -1)  # a slice has an outcome at least
    tail = F.slice("_oks", F.greatest(F.size("_oks") - (WINDOW - 2), F.lit(1)), WINDOW - 1)
    cut = cut.withColumn("_tail", tail).withColumn("_before", F.flatten(F.collect_list("_tail").over(before)))
    cut = cut.withColumn("_before", F.slice("_before", F.greatest(F.size("_before") - (WINDOW - 2), F.lit(1)), WINDOW - 1))
    cut = cut.withColumns({"_all": F.concat("_before", "_oks"), "_b": F.size("_before")})
    # of each outcome how many of the last ten succeeded; then 1 where the size grows after it, -1 where it shrinks
    upto = lambda i: F.slice("_all", F.greatest(F.col("_b") + i - (WINDOW - 2), F.lit(1)), F.least(F.col("_b") + i + 1, F.lit(WINDOW)))
    cut = cut.withColumn("_good", F.transform("_oks", lambda _, i: F.aggregate(upto(i), F.lit(0), lambda a, b: a + b)))
    of = lambda i: F.least(F.col("_b") + i + 1, F.lit(WINDOW))
    moves = F.transform("_good", lambda g, i: F.when(g < LOW_RATE * of(i), -1).when(g > HIGH_RATE * of(i), 1).otherwise(0))
    cut = cut.withColumn("_moves", moves).drop("_all", "_good", "_b")

    def after(size: Column, move: Column) -> Column:
        shrunk = F.greatest(F.lit(least).cast("long"), F.floor(size * 2 / 3).cast("long"))
        grown = F.least(F.lit(initial).cast("long"), F.floor(size * 3 / 2).cast("long"))
        return F.when(move < 0, shrunk).when(move > 0, grown).otherwise(size)

    sizes = F.array(*[F.lit(x).cast("long") for x in possible_sizes(initial, least)])
    # what a slice makes of each possible size
    cut = cut.withColumns({"_to": F.transform(sizes, lambda s: F.aggregate("_moves", s, after)), "_n": F.size("_oks").cast("long")})
    ordered = F.array_sort(F.collect_list(F.struct("_slice", "_to", "_n")))
    start = F.struct(F.lit(initial).cast("long").alias("size"), F.lit(0).cast("long").alias("n"), F.expr("cast(array() as array<struct<slice:bigint,size:bigint,n:bigint>>)").alias("starts"))

    def on(s: Column, x: Column) -> Column:
        here = F.array(F.struct(x["_slice"].alias("slice"), s["size"].alias("size"), s["n"].alias("n")))
        size = F.element_at(x["_to"], F.array_position(sizes, s["size"]).cast("int"))
        return F.struct(size.alias("size"), (s["n"] + x["_n"]).alias("n"), F.concat(s["starts"], here).alias("starts"))

    starts = cut.groupBy("_key").agg(F.aggregate(ordered, start, on)["starts"].alias("starts")).select(F.col("_key").alias("_k"), F.explode("starts").alias("s")).select("_k", "s.*")
    placed = cut.join(starts, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("slice")))
    state = F.struct(F.col("size"), F.expr("cast(array() as array<bigint>)").alias("sizes"))

    def step(s: Column, move: Column) -> Column:
        size = after(s["size"], move)
        return F.struct(size.alias("size"), F.concat(s["sizes"], F.array(size)).alias("sizes"))

    made = placed.select(F.col("_key").alias(key), "n", F.posexplode(F.aggregate("_moves", state, step)["sizes"]).alias("_at", "size"))
    return made.select(key, (F.col("n") + F.col("_at")).cast("int").alias("i"), "size")


def progress_text(metrics: DataFrame, remaining: Column, elapsed: Column, batch_size: Column) -> DataFrame:
    """A line on a run, from run_metrics()."""
    wpm = throughput(F.col("scored"), elapsed)
    text = F.format_string(
        "scored=%d failed=%d remaining=%d wpm=%.1f eta=%s batch_size=%d success_rate=%.0f%%",
        F.col("scored"), F.col("failed"), remaining, wpm, duration_text(eta_seconds(remaining, wpm)), batch_size, success_rate(F.col("successful"), F.col("batches")) * 100,
    )
    return metrics.select(text.alias("progress"))
