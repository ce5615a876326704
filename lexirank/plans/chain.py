"""A chain of rebalances towards a target histogram."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rebalance import apply_transition
from ..transitions import Transition, parse_transition

# The steps, the targets of levels 1, 2, 3 and 5 (4 has the rest), and the ratios allowed.
STEPS = ("1-2:1", "1-2:1", "1-2:1", "2-3:2", "2-3:2", "3-4:3", "3-4:3", "4-5:4")
TARGETS = {1: 2500, 2: 7500, 3: 15000, 5: 30000}
LEAST_RATIO, MOST_RATIO = 0.01, 0.99


def chain_targets(total: int, targets: dict[int, int] = TARGETS) -> dict[int, int]:
    rest = total - sum(targets.values())
    if rest < 1:
        raise ValueError(f"of {total} words the targets leave {rest} for level 4")
    return targets | {4: rest}


def step_ratio(transition: Transition, counts: dict[int, int], targets: dict[int, int]) -> float:
    pool, target = sum(counts.get(x, 0) for x in transition.sources), targets[transition.to]
    if pool <= 1 or not 1 <= target < pool:
        raise ValueError(f"{transition.text}: the target {target} does not fit the pool of {pool}")
    ratio = target / pool
    if not LEAST_RATIO <= ratio <= MOST_RATIO:
        raise ValueError(f"{transition.text}: the ratio {ratio} is not from {LEAST_RATIO} to {MOST_RATIO}")
    return ratio


def run_chain(words: DataFrame, *, targets: dict[int, int] = TARGETS, first: int = 1, cut: Callable[[DataFrame, int], DataFrame] = lambda df, step: df, picks: Callable[[DataFrame, int], Callable | None] = lambda df, step: None, **options) -> DataFrame:
    """word_id, level, ... after the steps from `first` on. Each step is a run of its own: words it takes may be taken again by the next.

    The pool of a step comes from one aggregate of the table as it then is; `cut(df, step)` may write it, which
    ends lineage and is where a chain is taken up again; `picks(df, step)` gives what picks its words, if not the score.
    """
    total = words.count()
    goal = chain_targets(total, targets)
    for number, text in enumerate(STEPS, 1):
        if number < first:
            continue
        transition = parse_transition(text)
        counts = {r["level"]: r["count"] for r in words.groupBy("level").count().collect()}
        ratio = step_ratio(transition, counts, goal)
        after = apply_transition(words.withColumn("processed", F.lit(False)), transition, ratio=ratio, pick=picks(words, number), **options)
        words = cut(after.select(*words.columns), number)
    return words
