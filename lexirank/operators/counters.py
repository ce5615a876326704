"""Counters taken on the way: sums over the rows of a plan, made by the action that runs it, without another pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import MESSAGES, error_category

#: How a result found its word, and what was done to make an answer readable: the columns `matched` and `stage` of parsed batches.
MATCHES = ("id", "word", "fuzzy", "unresolved")
CATEGORIES = (*[name for name in MESSAGES if name.isupper()], "OTHER")


def scoring() -> dict[str, Column]:
    """Of SCORED rows: words with and without a level, attempts, how levels were matched, and errors by category."""
    some = F.col("rarity_level").isNotNull()
    category = error_category(F.col("error"))
    return {
        "scored": F.count_if(some),
        "failed": F.count_if(~some),
        "attempts": F.coalesce(F.sum("attempts"), F.lit(0)),
        "retried": F.count_if(F.col("attempts") > 1),
        **{f"by_{m}": F.count_if(some & F.col("matched").eqNullSafe(m)) for m in MATCHES[:-1]},
        **{f"error_{c.lower()}": F.count_if(~some & (category == c)) for c in CATEGORIES},
    }


def parsing(stages: tuple[str, ...]) -> dict[str, Column]:
    """Of parsed batches: words by how they were matched, and by the stage of repair of their answer."""
    return {f"by_{m}": F.count_if(F.col("matched") == m) for m in MATCHES} | {f"stage_{s}": F.count_if(F.col("stage") == s) for s in stages}


def transitions() -> dict[str, Column]:
    """Of the words after a transition: those in batches, those called common, and those whose level changed."""
    taken = F.col("batch").isNotNull()
    return {"eligible": F.count_if(taken), "common": F.count_if(taken & F.col("is_common")), "switched": F.count_if(taken & (F.col("level") != F.col("previous_level")))}


def counted(df: DataFrame, measures: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """df, and a function that gives the measures once an action has run over it; it waits for that action."""
    seen = Observation(f"counters-{uuid.uuid4().hex}")
    return df.observe(seen, *[c.alias(name) for name, c in measures.items()]), lambda: dict(seen.get)
