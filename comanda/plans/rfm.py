"""Recency, frequency and monetary segmentation.

The five-step scores need only the values at which the percent rank passes 0.2, 0.4, 0.6 and
0.8. Those twelve cut values come from the counts per distinct value of the three metrics; the
customers themselves are then scored in place, without a sort, a join or another shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import days_since, first_match, null_to_zero, rfm_segment
from comanda.operators.ranking import ROWS_PER_BUCKET, percent_rank, value_positions
from comanda.plans.shared import FLAGS, customer_lines, reference_date, today
from comanda.schemas import GOLD, conform
from comanda.staging import Staged, stage

METRICS = ("RECENCY", "FREQUENCY", "MONETARY")
# Percent-rank limits between scores (fixed values).
SCORE_LIMITS = (0.20, 0.40, 0.60, 0.80)
METRIC_TYPE = "decimal(38,2)"


def base_of(facts: DataFrame) -> DataFrame:
    """Per customer: last purchase, distinct orders, item revenue, any loyalty line.

    ``facts`` are ``customer_lines`` or ``customer_orders``.
    """
    return (
        facts.groupBy("CUSTOMER_ID")
        .agg(
            F.max("LAST_TIME").alias("LAST_PURCHASE_DATE"),
            F.count_distinct("ORDER_ID").alias("FREQUENCY"),
            F.sum("SPEND").alias("MONETARY"),
            F.max("IS_LOYALTY").alias("IS_LOYALTY"),
        )
        .withColumn("MONETARY", F.col("MONETARY").cast("decimal(31,2)"))
    )


def rfm_base(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    return base_of(customer_lines(items, blank_as_null))


def with_recency(base: DataFrame) -> DataFrame:
    """Add RECENCY. The latest purchase of any customer is the reference date."""
    last = base.select(F.col("LAST_PURCHASE_DATE").alias("CREATION_TIME_UTC"))
    return base.withColumn(
        "RECENCY", days_since("LAST_PURCHASE_DATE", today(last, reference_date(last)))
    )


def _cut_name(metric: str, limit: float) -> str:
    return f"{metric}_{round(limit * 100)}"


def score_cuts(customers: Staged, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row with the cut values of the three metrics.

    Recency: the largest value ranked at or below each limit. Frequency and monetary: the
    smallest value ranked at or above it; NULL where no value gets that far.
    """
    long = customers.df.selectExpr(
        *[f"cast({m} AS {METRIC_TYPE}) AS {m}" for m in METRICS]
    ).unpivot([], list(METRICS), "METRIC", "VALUE")
    ranked = value_positions(
        customers.with_df(long, len(METRICS)), "VALUE", ["METRIC"], rows_per_bucket=rows_per_bucket
    ).withColumn("PR", percent_rank())

    def cut(metric: str, limit: float) -> Column:
        pick, side = ("max", "<=") if metric == "RECENCY" else ("min", ">=")
        return F.expr(
            f"{pick}(VALUE) FILTER (WHERE METRIC = '{metric}' AND PR {side} {limit}D)"
            f" AS {_cut_name(metric, limit)}"
        )

    return ranked.agg(*[cut(m, q) for m in METRICS for q in SCORE_LIMITS])


def _score(metric: str, value: str, limit_of: Callable[[float], str]) -> str:
    """CASE text for a score of 5 to 1; recency scores low values high, the others high ones."""
    low_is_good = metric == "RECENCY"
    limits = SCORE_LIMITS if low_is_good else SCORE_LIMITS[::-1]
    steps = [
        f"WHEN {value} {'<=' if low_is_good else '>='} {limit_of(q)} THEN {5 - i}"
        for i, q in enumerate(limits)
    ]
    if low_is_good:  # an unknown recency ranks first
        steps.insert(0, f"WHEN {value} IS NULL THEN 5")
    return f"CASE {' '.join(steps)} ELSE 1 END AS {metric[0]}_SCORE"


def with_scores(customers: Staged, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    cuts = score_cuts(customers, rows_per_bucket)
    row = cuts.select(F.struct(*cuts.columns)).scalar().alias("cuts")
    scores = [_score(m, m, lambda q, m=m: f"cuts.{_cut_name(m, q)}") for m in METRICS]
    scored = customers.df.select("*", row).selectExpr(*customers.df.columns, *scores)
    return scored.withColumn("RFM_SCORE", F.concat("R_SCORE", "F_SCORE", "M_SCORE"))


def score_staged(base: Staged, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return with_scores(base.with_df(with_recency(base.df)), rows_per_bucket)


def rfm_of(facts: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return _segments(base_of(facts), rows_per_bucket)


def rfm_of_totals(totals: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rfm`` from ``customer_totals``."""
    spent = [F.col(f"SPEND_{flag}") for flag in FLAGS]
    monetary = F.when(F.coalesce(*spent).isNotNull(), sum((null_to_zero(c) for c in spent), F.lit(0)))
    base = totals.select(
        "CUSTOMER_ID",
        F.col("LAST_TIME").alias("LAST_PURCHASE_DATE"),
        F.col("ORDERS").alias("FREQUENCY"),
        monetary.cast("decimal(31,2)").alias("MONETARY"),
        first_match((F.col("HAS_LOYAL"), True), (F.col("HAS_PLAIN"), False)).alias("IS_LOYALTY"),
    )
    return _segments(base, rows_per_bucket)


def _segments(base: DataFrame, rows_per_bucket: int) -> DataFrame:
    scored = score_staged(stage(base, "rfm"), rows_per_bucket)
    segment = rfm_segment(F.col("R_SCORE"), F.col("F_SCORE"), F.col("M_SCORE"))
    return conform(
        scored.withColumn("CUSTOMER_SEGMENT", segment), GOLD["customer_segmentation"]
    )


def rfm(
    items: DataFrame, blank_as_null: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    return rfm_of(customer_lines(items, blank_as_null), rows_per_bucket)
