"""Quantiles that can be rolled up: sketches per group that merge into those of any coarser grouping.

A quantile of a month is no function of the quantiles of its days, but their KLL sketches merge. A sketch holds a few
thousand values however many rows its group has. A quantile read from it, merged or not, lies within ``rank_error`` of
the rank asked for, in 99 of 100 readings. ``ranking.exact_quantiles`` is the exact way, for one grouping at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH, ROWS, LOWEST, HIGHEST = "SKETCH", "ROWS", "LOWEST", "HIGHEST"
K = 800


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank may be off, at 99 % confidence (0.35 % for 800)."""
    return 2.296 / k**0.9723


def quantile_states(df: DataFrame, column: str, by: Sequence[str], k: int = K) -> DataFrame:
    """Per ``by`` the sketch of the column, its rows, and its exact ends; a group without a value has no row.

    NULL and NaN are no values. ``by`` may hold NULL, which is a group.
    """
    value = F.col(column).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value)).select(*by, value.alias("_value"))
    return known.groupBy(*by).agg(
        F.kll_sketch_agg_double("_value", F.lit(k)).alias(SKETCH),
        F.count("_value").alias(ROWS),
        F.min("_value").alias(LOWEST),
        F.max("_value").alias(HIGHEST),
    )


def merged_states(states: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """States of a coarser grouping, from states alone; they are states again. Partial merges run before the shuffle."""
    found = states.groupBy(*by).agg(
        F.kll_merge_agg_double(SKETCH, F.lit(k)).alias(SKETCH),
        F.sum(ROWS).alias(ROWS),
        F.min(LOWEST).alias(LOWEST),
        F.max(HIGHEST).alias(HIGHEST),
    )
    return found.where(F.col(ROWS) > 0)


def quantiles(states: DataFrame, points: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, the number of rows, and a column for each point (0 to 1). The points 0 and 1 are exact."""

    def read(point: float) -> Column:
        if not 0 <= point <= 1:
            raise ValueError("points lie between 0 and 1")
        if point in (0, 1):
            return F.col(HIGHEST if point else LOWEST)
        return F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(point)))

    return states.select(*by, ROWS, *[read(p).alias(name) for name, p in points.items()])
