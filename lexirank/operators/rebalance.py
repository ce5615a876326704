"""Rebalancing of level histograms: batches from counts, then one plan of windows for each transition.

Picks are exact, so what a batch holds depends on counts alone: one aggregate of the source levels tells of which
ranks of each level batches are made, and a word's batch is an expression of its rank. No loop over words or
batches runs, and nothing is joined to find a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..transitions import Transition, check_disjoint

# Defaults of a rebalance.
BATCH_SIZE, RATIO = 600, 1 / 3

#: Rows that one task ranks.
SLICE_ROWS = 500_000


def largest_remainder(size: int, weights: Sequence[int]) -> list[int]:
    """Whole shares of size in proportion to weights: rounded down, what is left to the largest fractions, of equal ones the first."""
    total = float(sum(weights))
    exact = [size * (w / total) for w in weights]
    shares = [int(x) for x in exact]
    for i in sorted(range(len(weights)), key=lambda i: (shares[i] - exact[i], i))[: size - sum(shares)]:
        shares[i] += 1
    return shares


def within_supply(shares: list[int], supply: Sequence[int]) -> list[int]:
    """Shares cut to what there is; what is cut goes, one at a time, to where most is left over."""
    cut = [min(q, s) for q, s in zip(shares, supply)]
    for _ in range(sum(shares) - sum(cut)):
        left = [s - q for q, s in zip(cut, supply)]
        if max(left) <= 0:
            break
        cut[left.index(max(left))] += 1
    return cut


def plan_phases(counts: dict[int, int], batch_size: int) -> list[dict]:
    """Runs of batches in a row that hold the same number of words of each level.

    Batches hold levels in proportion to the initial counts, as long as there are so many. A phase has: the number of its
    first batch, of its batches, their size, the words in batches before, and by level the words in each batch and
    those taken before. Of one level or two there are five phases at most.
    """
    levels = sorted(counts)
    left, taken = [counts[x] for x in levels], [0] * len(levels)
    out, done, batch = [], 0, 0
    while sum(left):
        size = min(batch_size, sum(left))
        wanted = largest_remainder(size, [counts[x] for x in levels]) if len(levels) > 1 else [size]
        shares, alike = within_supply(wanted, left), 1
        if size == batch_size and shares == wanted:
            alike = min(n // s for n, s in zip(left, shares) if s)
        elif size == batch_size and sum(n > 0 for n in left) == 1:
            alike = sum(left) // size
        out.append({"batch": batch, "batches": alike, "size": size, "done": done, "shares": dict(zip(levels, shares)), "taken": dict(zip(levels, taken))})
        taken, left = [t + s * alike for t, s in zip(taken, shares)], [n - s * alike for n, s in zip(left, shares)]
        done, batch = done + size * alike, batch + alike
    return out


def batch_columns(phases: list[dict]) -> tuple[Column, Column, Column]:
    """Of rows (level, _rank from 1) their batch; and, by the column `batch`, its size and the words in batches before it."""
    batch, size, done = F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(None).cast("long")
    for p in phases:
        for level, share in p["shares"].items():
            if share:
                at = F.col("_rank") - 1 - p["taken"][level]
                batch = F.when((F.col("level") == level) & at.between(0, share * p["batches"] - 1), p["batch"] + F.floor(at / share)).otherwise(batch)
    for p in phases:
        inside = F.col("batch").between(p["batch"], p["batch"] + p["batches"] - 1)
        size = F.when(inside, p["size"]).otherwise(size)
        done = F.when(inside, p["done"] + (F.col("batch") - p["batch"]) * p["size"]).otherwise(done)
    return batch.cast("long"), size.cast("int"), done.cast("long")


def _chosen(by: Column, values: list) -> Column:
    """The value of the number that a column holds."""
    return reduce(lambda rest, nv: F.when(by == nv[0], nv[1]).otherwise(rest), list(enumerate(values))[1:], values[0] if isinstance(values[0], Column) else F.lit(values[0]))


def with_batches(ranked: DataFrame, plans: list[list[dict]], ratio: float) -> DataFrame:
    """Rows (level, _rank from 1, _of: which plan) with their batch, its size and its target: the rounded share of all words up to its end, less that up to its start."""
    made = [batch_columns(phases) for phases in plans]
    share = lambda n: F.bround(n.cast("double") * F.lit(float(ratio)))
    rows = ranked.withColumn("batch", _chosen(F.col("_of"), [m[0] for m in made]))
    rows = rows.withColumns({"size": _chosen(F.col("_of"), [m[1] for m in made]), "_done": _chosen(F.col("_of"), [m[2] for m in made])})
    return rows.withColumn("target", (share(F.col("_done") + F.col("size")) - share(F.col("_done"))).cast("int")).drop("_done", "_rank")


def shuffle_key(word_id: Column, seed: int = 0) -> Column:
    """A portable keyed hash that orders words at random."""
    return F.pmod(F.pmod(word_id, F.lit(4294967296)) * F.lit(2654435761) + F.lit(seed), F.lit(4294967296))


def _ranked(rows: DataFrame, total: int, seed: int) -> DataFrame:
    """The rows with _rank, from 1 in each level, in the order of the shuffle key.

    Slices of the key's range are ranked side by side and moved up by what earlier slices hold: counts of so many
    slices as there are SLICE_ROWS, so that no task sorts a whole level.
    """
    slices = max(1, -(-total // SLICE_ROWS))
    keyed = rows.withColumn("_key", shuffle_key(F.col("word_id"), seed)).withColumn("_slice", F.floor(F.col("_key") * slices / 4294967296).cast("int"))
    if slices == 1:
        return keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("level").orderBy("_key", "word_id")).cast("long")).drop("_key", "_slice")
    upto = Window.partitionBy("level").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("level", "_slice").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("level", "_slice").orderBy("_key", "word_id"))
    return keyed.join(sizes.drop("_n"), ["level", "_slice"]).withColumn("_rank", (within + F.col("_before")).cast("long")).drop("_key", "_slice", "_before")


def level_counts(words: DataFrame) -> dict[int, int]:
    """Words that no transition has taken yet, by level."""
    return {r["level"]: r["n"] for r in words.where(~F.col("processed")).groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}


def batches_of(counts: dict[int, int], transition: Transition, batch_size: int) -> int:
    """How many batches a transition makes of so many words by level."""
    own = {x: counts[x] for x in transition.sources if counts.get(x)}
    return sum(p["batches"] for p in plan_phases(own, batch_size))


def apply_transition(words: DataFrame, transition: Transition, *, pick: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """apply_transitions() of one."""
    return apply_transitions(words, [transition], picks=[pick], **options)


def apply_transitions(
    words: DataFrame, transitions: Sequence[Transition], *, ratio: float = RATIO, batch_size: int = BATCH_SIZE, seed: int = 0, score: Column | str = "score", picks: Sequence[Callable[[DataFrame], DataFrame] | None] | None = None
) -> DataFrame:
    """The words (word_id, level, processed, ...) after transitions, with batch, target, is_common, previous_level and rule of the one that took them.

    Of every batch exactly its count of commonest words, by score, gets the commoner level and the others the rarer
    one. A word is processed once, and transitions have no source level in common, so what each takes is known at the
    start: all are one plan, with a ranking of the words by level and a window over batches. A `pick` may replace a
    transition's choice: from rows with batch and common_count to rows with is_common, as by a model; batches of which
    all or none are common are decided without it.
    """
    check_disjoint(list(transitions))
    picks = list(picks or [None] * len(transitions))
    every = level_counts(words)
    counts = [{x: every[x] for x in t.sources if every.get(x)} for t in transitions]
    rows = words.drop("batch", "target", "is_common", "previous_level", "rule")
    nothing = {"batch": F.lit(None).cast("long"), "target": F.lit(None).cast("int"), "is_common": F.lit(None).cast("boolean"), "previous_level": F.lit(None).cast("int"), "rule": F.lit("")}
    if not any(counts):
        return rows.withColumns(nothing)
    eligible = F.coalesce(F.col("level").isin(*[x for t in transitions for x in t.sources]) & ~F.col("processed"), F.lit(False))
    of = reduce(lambda rest, nt: F.when(F.col("level").isin(*nt[1].sources), nt[0]).otherwise(rest), enumerate(transitions), F.lit(None).cast("int"))
    ranked = _ranked(rows.where(eligible), sum(sum(c.values()) for c in counts), seed).withColumn("_of", of)
    dealt = with_batches(ranked, [plan_phases(c, batch_size) for c in counts], ratio)
    common = _chosen(F.col("_of"), [F.col("target") if t.to == t.common else F.col("size") - F.col("target") for t in transitions])
    dealt = dealt.withColumn("common_count", common)
    by_score = Window.partitionBy("_of", "batch").orderBy(score if isinstance(score, Column) else F.col(score), "word_id")
    scored = [n for n, pick in enumerate(picks) if pick is None]
    parts = []
    if scored:
        own = dealt if len(scored) == len(picks) else dealt.where(F.col("_of").isin(*scored))
        parts.append(own.withColumn("is_common", F.row_number().over(by_score) <= F.col("common_count")))
    for n, pick in enumerate(picks):
        if pick is not None:
            own = dealt.where(F.col("_of") == n)
            parts.append(own.where("common_count <= 0 or common_count >= size").withColumn("is_common", F.col("common_count") > 0))
            parts.append(pick(own.where("common_count > 0 and common_count < size")))
    decided = reduce(DataFrame.unionByName, parts)
    new = F.when(F.col("is_common"), _chosen(F.col("_of"), [t.common for t in transitions])).otherwise(_chosen(F.col("_of"), [t.rare for t in transitions]))
    rule = F.concat(F.col("level").cast("string"), F.lit("->"), new.cast("string"), F.lit(" (via "), _chosen(F.col("_of"), [t.text for t in transitions]), F.lit(")"))
    changed = decided.withColumns({"previous_level": F.col("level"), "rule": F.when(F.col("level") != new, rule).otherwise("")}).withColumns({"level": new.cast("int"), "processed": F.lit(True)})
    kept = rows.where(~eligible).withColumns(nothing)
    return changed.select(*kept.columns).unionByName(kept)


def rebalance(words: DataFrame, transitions: list[Transition], **options) -> DataFrame:
    """Disjoint transitions in one pass; words: word_id, level and what the score needs. processed is added where it is not there."""
    if "processed" not in words.columns:
        words = words.withColumn("processed", F.lit(False))
    return apply_transitions(words, transitions, **options)


def transition_summary(after: DataFrame) -> DataFrame:
    """One row: eligible, target_assigned and switched words of a transition."""
    took = F.col("previous_level").isNotNull()
    return after.where(took).agg(
        F.count(F.lit(1)).alias("eligible"), F.count_if(F.col("is_common")).alias("common_assigned"), F.count_if(F.col("level") != F.col("previous_level")).alias("switched")
    )


def switched_events(after: DataFrame, transition: Transition) -> DataFrame:
    rows = after.where(F.col("previous_level").isNotNull() & (F.col("previous_level") != F.col("level")))
    return rows.select("word_id", "previous_level", F.col("level").alias("new_level"), F.col("is_common").alias("selected_by_llm"), F.lit(transition.text).alias("transition"), "rule")


def checkpoint_rows(after: DataFrame, transition: Transition, fingerprint: str, timestamp: Column) -> DataFrame:
    """A row for each batch: what it processed and switched, under the transition and the input's fingerprint."""
    moved = F.when(F.col("previous_level") != F.col("level"), F.struct("word_id", F.col("level").alias("new_level"), "rule"))
    rows = after.where("batch is not null").groupBy("batch").agg(F.sort_array(F.collect_list("word_id")).alias("processed_word_ids"), F.array_sort(F.collect_list(moved)).alias("switched"))
    return rows.select(timestamp.cast("string").alias("timestamp"), F.lit(transition.text).alias("transition"), F.lit(fingerprint).alias("fingerprint"), "batch", "processed_word_ids", "switched")


def checkpoint_batches(rows: DataFrame, fingerprint: str) -> dict[str, int]:
    """How many batches of each transition a checkpoint has."""
    found = rows.where(F.col("fingerprint") == fingerprint).groupBy("transition").agg(F.count_distinct("batch").alias("n"))
    return {r["transition"]: r["n"] for r in found.collect()}


def checkpoint_rules(rows: DataFrame, fingerprint: str) -> DataFrame:
    """word_id and rule of each word that a checkpoint switched: of several the first."""
    own = rows.where(F.col("fingerprint") == fingerprint).select("timestamp", "batch", F.explode("switched").alias("s"))
    return own.groupBy(F.col("s.word_id").alias("word_id")).agg(F.min_by("s.rule", F.struct("timestamp", "batch")).alias("rule"))


def replay_checkpoint(words: DataFrame, rows: DataFrame, fingerprint: str) -> DataFrame:
    """The words as their checkpoint left them: processed ones, and of each switched one the first switch. Unknown ids are dropped."""
    own = rows.where(F.col("fingerprint") == fingerprint)
    done = own.select(F.explode("processed_word_ids").alias("word_id")).distinct().withColumn("_done", F.lit(True))
    switch = own.select("timestamp", "batch", F.explode("switched").alias("s")).groupBy(F.col("s.word_id").alias("word_id"))
    switch = switch.agg(F.min_by("s", F.struct("timestamp", "batch"))["new_level"].alias("_new"))
    old = F.coalesce(F.col("processed"), F.lit(False)) if "processed" in words.columns else F.lit(False)
    out = words.withColumn("processed", old).join(done, "word_id", "left").join(switch, "word_id", "left")
    return out.withColumns({"level": F.coalesce("_new", "level"), "processed": F.col("processed") | F.coalesce("_done", F.lit(False))}).drop("_done", "_new")


def resume_stats(rows: DataFrame) -> DataFrame:
    """One row of checkpoint rows: batches, processed and switched words."""
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("batches"), total("processed_word_ids").alias("processed"), total("switched").alias("switched"))


#: Batches whose running sums one task forms.
SUMMED_BATCHES = 10_000


def running_sums(rows: DataFrame, order: str, *names: str) -> DataFrame:
    """The rows with each named column summed up to and with each row, by a whole number that tells their order; slices are summed side by side."""
    rows = rows.withColumn("_slice", F.floor(F.col(order) / SUMMED_BATCHES))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("_slice").agg(*[F.sum(c).alias(c) for c in names])
    slices = slices.select("_slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in names])
    within = Window.partitionBy("_slice").orderBy(order)
    sums = {c: (F.sum(c).over(within) + F.col(f"_{c}")).cast("long") for c in names}
    return rows.join(slices, "_slice").withColumns(sums).drop("_slice", *[f"_{c}" for c in names])


def progress_rows(after: DataFrame, transition: Transition) -> DataFrame:
    """A row for each batch: its ids, those that got the target level, their words where there are such, the batch's switches,
    the words still to come, and the distribution of all levels after it."""
    to_target = F.col("is_common") if transition.to == transition.common else ~F.col("is_common")
    was = F.coalesce("previous_level", "level")
    before = {r["level"]: r["count"] for r in after.groupBy(was.alias("level")).count().collect()}
    levels = sorted({transition.common, transition.rare, *transition.sources})
    by_id = lambda c, cond=None: F.transform(F.sort_array(F.collect_list(F.struct("word_id", c) if cond is None else F.when(cond, F.struct("word_id", c)))), lambda x: x[c])
    words = {"selected_words": by_id("word"), "picked_words": by_id("word", to_target)} if "word" in after.columns else {}
    rows = after.where("batch is not null").groupBy("batch").agg(
        F.count(F.lit(1)).alias("size"),
        F.first("target").alias("target"),
        F.sort_array(F.collect_list("word_id")).alias("selected_word_ids"),
        F.sort_array(F.collect_list(F.when(to_target, F.col("word_id")))).alias("picked_target_ids"),
        F.count_if(F.col("previous_level") != F.col("level")).alias("switched"),
        *[(F.count_if(F.col("level") == x) - F.count_if(F.col("previous_level") == x)).alias(f"_more{x}") for x in levels],
        *[c.alias(name) for name, c in words.items()],
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    rows = running_sums(rows.withColumn("_upto", F.col("size")), "batch", "_upto", *[f"_more{x}" for x in levels])
    share = [y for x in range(1, 6) for y in (F.lit(str(x)), F.lit(before.get(x, 0)).cast("long") + (F.col(f"_more{x}") if x in levels else 0))]
    rows = rows.withColumns({"remaining": F.lit(total).cast("long") - F.col("_upto"), "distribution": F.create_map(*share), "transition": F.lit(transition.text)})
    return rows.drop("_upto", *[f"_more{x}" for x in levels])


def source_mix(after: DataFrame) -> DataFrame:
    """Of each batch the source levels as [level:count ...]."""
    per = after.where("batch is not null").groupBy("batch", "previous_level").agg(F.count(F.lit(1)).alias("n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("previous_level", "n"))), lambda x: F.format_string("%d:%d", x["previous_level"], x["n"]))
    return per.groupBy("batch").agg(F.concat(F.lit("["), F.array_join(parts, " "), F.lit("]")).alias("mix"))


def rebalanced_output(table: DataFrame, after: DataFrame, *, model: str, run: str, at: Column) -> DataFrame:
    """The input's rows and columns with final_level and what changed it: the rule is empty for rows that didn't change, the rest of the marks stay."""
    found = after.select(F.col("word_id").alias("_id"), F.col("level").alias("_level"), "rule").withColumnRenamed("rule", "_rule")
    changed = F.coalesce(F.col("_rule") != "", F.lit(False))
    old = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in table.columns else F.lit("")
    out = table.join(found, F.col("word_id") == F.col("_id"), "left")
    marks = {"rebalance_model": F.lit(model), "rebalance_run": F.lit(run), "rebalanced_at": at.cast("string")}
    cols = {"final_level": F.col("_level"), "rebalance_rule": F.when(changed, F.col("_rule")).otherwise("")} | {c: F.when(changed, v).otherwise(old(c)) for c, v in marks.items()}
    return out.withColumns(cols).drop("_id", "_level", "_rule")
