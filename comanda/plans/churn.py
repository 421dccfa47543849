"""Churn indicators.

All indicators of a customer come from one aggregate. The mean gap between consecutive lines
needs no sort: the day differences of a sorted sequence add up to last day minus first day, so
the mean is that span over the number of gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comanda.functions.metrics import (
    churn_status,
    days_since,
    null_to_zero,
    ratio,
    spend_change_percent,
    spend_period,
)
from comanda.plans.shared import PERIODS, customer_lines, today, with_customer, with_revenue
from comanda.schemas import GOLD, conform

TIME = "CREATION_TIME_UTC"


def last_order(items: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    lines = with_customer(items)
    return (
        lines.groupBy("CUSTOMER_ID")
        .agg(F.max(TIME).alias("LAST_ORDER_DATE"))
        .withColumn("DAYS_SINCE_LAST_ORDER", days_since("LAST_ORDER_DATE", today(lines, reference)))
    )


def order_gaps(items: DataFrame, step: str = "hour") -> DataFrame:
    """Per line: the time of the customer's line before it and the gap in days.

    Lines are ordered by time, then ORDER_ID and LINEITEM_ID. Of the lines that share a time only
    the first looks further back, so the sort runs over the distinct times of a customer, hour by
    hour (or another ``step``), and the last time of each hour is carried to the next. No window
    holds more than one customer's distinct times of one hour, or one customer's hours; the join
    back splits a crowded time like any skewed join, as the side with the times has one row per
    key.
    """
    line = F.struct("ORDER_ID", "LINEITEM_ID")
    hour = F.date_trunc(step, TIME).alias("_hour")
    lines = with_customer(items).select("CUSTOMER_ID", "ORDER_ID", "LINEITEM_ID", TIME)

    times = (
        lines.where(F.col(TIME).isNotNull())
        .groupBy("CUSTOMER_ID", TIME)
        .agg(F.min(line).alias("_first_line"))
        .withColumn("_hour", hour)
    )
    hours = Window.partitionBy("CUSTOMER_ID").orderBy("_hour")
    carried = (
        lines.where(F.col(TIME).isNotNull())
        .groupBy("CUSTOMER_ID", hour)
        .agg(F.max(TIME).alias("_last"))
        .select("CUSTOMER_ID", "_hour", F.lag("_last").over(hours).alias("_carried"))
    )
    inside_hour = Window.partitionBy("CUSTOMER_ID", "_hour").orderBy(TIME)
    before = (
        times.withColumn("_inside", F.lag(TIME).over(inside_hour))
        .join(carried, ["CUSTOMER_ID", "_hour"])
        .select(
            "CUSTOMER_ID", TIME, "_first_line", F.coalesce("_inside", "_carried").alias("_before")
        )
    )
    previous = F.when(F.col("_first_line").eqNullSafe(line), F.col("_before")).otherwise(F.col(TIME))
    return (
        lines.join(before, ["CUSTOMER_ID", TIME], "left")
        .withColumn("PREVIOUS_ORDER_DATE", previous)
        .select(
            "CUSTOMER_ID",
            "ORDER_ID",
            "LINEITEM_ID",
            TIME,
            "PREVIOUS_ORDER_DATE",
            F.datediff(TIME, "PREVIOUS_ORDER_DATE").alias("ORDER_GAP_DAYS"),
        )
    )


def _mean_gap(first: Column, last: Column, known_times: Column) -> Column:
    return F.when(known_times > 1, ratio(F.datediff(last, first), known_times - 1))


def avg_gap(items: DataFrame, per: str = "line") -> DataFrame:
    """Mean days between a customer's consecutive lines, or orders with ``per="order"``.

    NULL with fewer than two. An order counts once, at the time of its first line.
    """
    lines = with_customer(items)
    if per == "order":
        lines = lines.groupBy("CUSTOMER_ID", "ORDER_ID").agg(F.min(TIME).alias(TIME))
    elif per != "line":
        raise ValueError(f"per must be 'line' or 'order', not {per!r}")
    gap = _mean_gap(F.min(TIME), F.max(TIME), F.count(TIME))
    return lines.groupBy("CUSTOMER_ID").agg(gap.alias("AVG_ORDER_GAP_DAYS"))


def spend_periods(items: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Lines of the last 180 days with their period, RECENT or PREVIOUS."""
    lines = with_revenue(with_customer(items), "ORDER_REVENUE")
    return (
        lines.withColumn("DAYS_FROM_REFERENCE", days_since(TIME, today(lines, reference)))
        .withColumn("SPEND_PERIOD", spend_period(F.col("DAYS_FROM_REFERENCE")))
        .where(F.col("SPEND_PERIOD").isNotNull())
    )


def spend_by_period(items: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """PREVIOUS_SPEND and RECENT_SPEND of the customers with lines in either period."""
    return (
        spend_periods(items, reference)
        .groupBy("CUSTOMER_ID")
        .pivot("SPEND_PERIOD", list(PERIODS))
        .agg(F.sum("ORDER_REVENUE"))
        .select("CUSTOMER_ID", *[null_to_zero(F.col(p)).alias(f"{p}_SPEND") for p in PERIODS])
    )


def spend_change(items: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    return spend_by_period(items, reference).withColumn(
        "SPEND_CHANGE_PERCENT",
        spend_change_percent(F.col("RECENT_SPEND"), F.col("PREVIOUS_SPEND")),
    )


def _indicators(facts: DataFrame, now: Column, per: str) -> DataFrame:
    """One row per customer: last time, mean gap, spend of both periods and rows in a period."""
    period = spend_period(days_since("ORDER_DAY", now))
    facts = facts.select(
        "CUSTOMER_ID", "ORDER_ID", "FIRST_TIME", "LAST_TIME", "TIMES", "SPEND", period.alias("_period")
    )
    parts = [
        *[F.expr(f"sum(SPEND) FILTER (WHERE _period = '{p}') AS _{p}") for p in PERIODS],
        F.count("_period").alias("_in_period"),
        F.min("FIRST_TIME").alias("_first"),
        F.max("LAST_TIME").alias("_last"),
    ]
    if per == "line":
        result = facts.groupBy("CUSTOMER_ID").agg(*parts, F.sum("TIMES").alias("_times"))
        gap = _mean_gap(F.col("_first"), F.col("_last"), F.col("_times"))
    else:
        orders = facts.groupBy("CUSTOMER_ID", "ORDER_ID").agg(*parts)
        result = orders.groupBy("CUSTOMER_ID").agg(
            *[F.sum(c).alias(c) for c in (*[f"_{p}" for p in PERIODS], "_in_period")],
            F.max("_last").alias("_last"),
            F.min("_first").alias("_first"),
            F.max("_first").alias("_last_first"),
            F.count("_first").alias("_times"),
        )
        gap = _mean_gap(F.col("_first"), F.col("_last_first"), F.col("_times"))
    return result.withColumn("AVG_ORDER_GAP_DAYS", gap)


def churn_of(facts: DataFrame, reference: DataFrame | None = None, *, per: str = "line") -> DataFrame:
    """All indicators, one row per customer; no spend columns without a line in 180 days.

    ``facts`` are ``customer_lines`` or ``customer_orders``.
    """
    if per not in ("line", "order"):
        raise ValueError(f"per must be 'line' or 'order', not {per!r}")
    now = today(facts.select(F.col("LAST_TIME").alias(TIME)), reference)
    return _statuses(_indicators(facts, now, per), now)


def churn_of_totals(totals: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """``churn`` from ``customer_totals`` of the same reference date."""
    now = today(totals.select(F.col("LAST_TIME").alias(TIME)), reference)
    known = totals.select(
        "CUSTOMER_ID",
        *[F.col(f"SPEND_{p}").alias(f"_{p}") for p in PERIODS],
        F.col("IN_PERIOD").alias("_in_period"),
        F.col("LAST_TIME").alias("_last"),
        _mean_gap(F.col("FIRST_TIME"), F.col("LAST_TIME"), F.col("TIMES")).alias("AVG_ORDER_GAP_DAYS"),
    )
    return _statuses(known, now)


def _statuses(indicators: DataFrame, now: Column) -> DataFrame:
    in_period = F.col("_in_period") > 0
    result = indicators.select(
        "CUSTOMER_ID",
        F.col("_last").alias("LAST_ORDER_DATE"),
        days_since("_last", now).alias("DAYS_SINCE_LAST_ORDER"),
        "AVG_ORDER_GAP_DAYS",
        *[F.when(in_period, null_to_zero(F.col(f"_{p}"))).alias(f"{p}_SPEND") for p in PERIODS],
    )
    change = spend_change_percent(F.col("RECENT_SPEND"), F.col("PREVIOUS_SPEND"))
    result = result.withColumns(
        {
            "SPEND_CHANGE_PERCENT": F.when(F.col("RECENT_SPEND").isNotNull(), change),
            "CHURN_STATUS": churn_status(F.col("DAYS_SINCE_LAST_ORDER")),
        }
    )
    return conform(result, GOLD["customer_churn_indicators"])


def churn(
    items: DataFrame,
    reference: DataFrame | None = None,
    *,
    per: str = "line",
    blank_as_null: bool = False,
) -> DataFrame:
    return churn_of(customer_lines(items, blank_as_null), reference, per=per)
