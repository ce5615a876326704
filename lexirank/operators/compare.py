"""Comparing and merging two or three label runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Limits beyond which a word is an outlier.
SPREAD_LIMIT, CONFIDENCE_LIMIT = 2, 0.55
RUNS = ("run_a", "run_b", "run_c")
STRATEGIES = ("median", "any_extremes")
COMPARISON_COLUMNS = (
    "word_id", "word", "type", "run_a_level", "run_a_confidence", "run_b_level", "run_b_confidence", "run_c_level", "run_c_confidence",
    "median_level", "spread", "is_outlier", "reason", "merge_strategy", "merge_rule", "final_level",
)
OUTLIER_COLUMNS = ("word_id", "word", "type", "run_a_level", "run_b_level", "run_c_level", "spread", "reason")
MERGE_RULES = {1: "any_level_1", 2: "any_level_2_over_median", 5: "any_level_5_over_median"}


def compare_runs(
    base: DataFrame, a: DataFrame, b: DataFrame, c: DataFrame | None = None, *, strategy: str = "median", spread_limit: int = SPREAD_LIMIT, confidence_limit: float = CONFIDENCE_LIMIT
) -> DataFrame:
    """A row of COMPARISON_COLUMNS for each base row: three left joins on the id, then expressions in one stage.

    Runs have one row for each word_id, with rarity_level and confidence. Words of runs that the base doesn't have drop out.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"the strategy is one of {', '.join(STRATEGIES)}")
    out = base.select("word_id", "word", "type")
    for name, run in (("run_a", a), ("run_b", b), ("run_c", c)):
        if run is None:
            out = out.withColumns({f"{name}_level": F.lit(None).cast("int"), f"{name}_confidence": F.lit(None).cast("double")})
        else:
            out = out.join(run.select("word_id", F.col("rarity_level").alias(f"{name}_level"), F.col("confidence").alias(f"{name}_confidence")), "word_id", "left")
    levels, confidences = [F.col(f"{n}_level") for n in RUNS], [F.col(f"{n}_confidence") for n in RUNS]
    known = F.size(F.array_compact(F.array(*levels)))
    low = S.any_below(confidence_limit, *confidences)
    median = F.col("median_level")
    out = out.withColumns({"median_level": S.median_level(*levels), "spread": S.spread(*levels).cast("int")})
    out = out.withColumns(
        {
            "is_outlier": (known >= 2) & ((F.col("spread") >= spread_limit) | low),
            "reason": S.outlier_reason(F.col("spread"), low, spread_limit, confidence_limit),
            "merge_strategy": F.lit(strategy),
            "final_level": (S.merge_any_extremes(median, *levels) if strategy == "any_extremes" else median).cast("int"),
            "merge_rule": _rule(median, levels) if strategy == "any_extremes" else F.lit("median"),
        }
    )
    return out.select(*COMPARISON_COLUMNS)


def _rule(median: Column, levels: list[Column]) -> Column:
    """Which rule decides: what the merge gives for the levels, if one of them is that extreme and the median lets it."""
    has = lambda x: F.exists(F.array(*levels), lambda v: F.coalesce(v == x, F.lit(False)))
    return F.when(has(1), MERGE_RULES[1]).when((median >= 3) & has(2), MERGE_RULES[2]).when(median.isin(3, 4) & has(5), MERGE_RULES[5]).otherwise("median_fallback")


def outliers(comparison: DataFrame) -> DataFrame:
    return comparison.where("is_outlier").select(*OUTLIER_COLUMNS)
