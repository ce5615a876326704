"""Picks of a rebalance by a model: each batch's commonest words, chosen on the executors."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.scalars import said
from .journal import Journal
from .scoring import Retry, Unreachable

#: From words, how many to pick, and whether a wrong count is to be mended, to local ids from 1. It must give the same answer when it is asked again.
Selector = Callable[[list[str], int, bool], list[int]]

REPAIRS = 2


def chosen(selector: Selector, words: list[str], expected: int, retry: Retry = Retry()) -> set[int]:
    """Places of the picks, from 0: exactly `expected` ones, unless single words can't be decided, which are not picked.

    A part whose selection has the wrong count is asked for it once more in plainer words, then halved, each half
    with its share of the picks, rounded half to even. A part of which all or none are to be picked is not asked for.
    """
    work, out = [(list(range(len(words))), expected, 0)], set()
    while work:
        part, count, depth = work.pop()
        if count <= 0:
            continue
        if count >= len(part):
            out.update(part)
            continue
        found, error = None, ""
        for attempt, repair in [(i, False) for i in range(1, retry.attempts + 1)] + [(i, True) for i in range(1, REPAIRS + 1)]:
            if repair and not said(error, "miscounted"):
                break
            try:
                ids = [i for i in dict.fromkeys(selector([words[i] for i in part], count, repair)) if 1 <= i <= len(part)]
                if len(ids) < count:
                    raise ValueError(f"expected exactly {count} selected, got {len(ids)}")
                found = ids[:count]
                break
            except Exception as x:  # noqa: BLE001  a selector may fail in any way
                error = str(x)
                if isinstance(x, (TimeoutError, ConnectionError)) or said(error, "unreachable"):
                    if attempt == retry.attempts:
                        raise Unreachable(error) from x
                elif said(error, "crash"):
                    time.sleep(retry.crash_wait * attempt)
        if found is not None:
            out.update(part[i - 1] for i in found)
        elif len(part) > 1 and depth < retry.depth:
            half = len(part) // 2
            first = round(count * half / len(part))
            work += [(part[half:], count - first, depth + 1), (part[:half], first, depth + 1)]
    return out


def picker(selector: Selector, *, retry: Retry = Retry(), journal: Journal | None = None) -> Callable[[DataFrame], DataFrame]:
    """`pick` for a transition: a batch's picks are what the selector chooses, by id order. With a journal each batch is asked for once, whatever runs again."""

    def pick(rows: DataFrame) -> DataFrame:
        def decide(batch: pd.DataFrame) -> pd.DataFrame:
            batch = batch.sort_values("word_id", kind="stable")
            name = f"batch-{int(batch['batch'].iloc[0])}"
            ids = [r["word_id"] for r in journal.get(name) or ()] if journal else []
            if not ids:
                places = chosen(selector, batch["word"].tolist(), int(batch["common_count"].iloc[0]), retry)
                ids = [int(x) for x in batch["word_id"].iloc[sorted(places)]]
                if journal:
                    journal.put(name, [{"word_id": i} for i in ids])
            return batch.assign(is_common=batch["word_id"].isin(ids))

        return rows.groupBy("batch").applyInPandas(decide, StructType([*rows.schema.fields, StructField("is_common", BooleanType())]))

    return pick
