"""Figures that join orders to spans of time: runs of days off, streaks of order days, spend of the last days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.operators.asof import DAY
from comanda.operators.cleaning import least_rows
from comanda.operators.intervals import RUN, overlap_join, runs_of_days
from comanda.operators.rolling import rolling_sum
from comanda.plans.shared import customer_lines, with_revenue

SPEND_DAYS = 90


def days_off(date_dim: DataFrame) -> DataFrame:
    """Runs of consecutive weekend days and holidays. Of several rows with one date the least counts."""
    calendar = least_rows(date_dim.where(F.col("date_key").isNotNull()), ["date_key"])
    return runs_of_days(calendar.where(F.col("is_weekend") | F.col("is_holiday")), "date_key")


def sales_by_days_off(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Revenue and orders of each run of days off; runs without a line have zeros.

    Lines are summed per order and day before they meet the runs, so the join moves a row per order.
    """
    lines = with_revenue(items, "TOTAL_REVENUE").withColumn("_day", F.to_date("CREATION_TIME_UTC"))
    orders = lines.groupBy("ORDER_ID", "_day").agg(F.sum("TOTAL_REVENUE").alias("_revenue"))
    runs = days_off(date_dim)
    met = overlap_join(orders, runs, ("_day", "_day"), RUN[:2], bucket_seconds=DAY)
    # An order whose lines lie on two days of a run is one order of it.
    per_order = met.groupBy(*RUN, "ORDER_ID").agg(F.sum("_revenue").alias("_revenue"))
    sums = per_order.groupBy(*RUN).agg(
        F.sum("_revenue").alias("TOTAL_REVENUE"), F.count("ORDER_ID").alias("TOTAL_ORDERS")
    )
    none = F.lit(0).cast(sums.schema["TOTAL_REVENUE"].dataType)
    both = sums.unionByName(runs.withColumns({"TOTAL_REVENUE": none, "TOTAL_ORDERS": F.lit(0).cast("bigint")}))
    return both.groupBy(*RUN).agg(
        F.coalesce(F.sum("TOTAL_REVENUE"), F.lit(0)).cast("decimal(38,2)").alias("TOTAL_REVENUE"),
        F.sum("TOTAL_ORDERS").alias("TOTAL_ORDERS"),
    )


def order_streaks(items: DataFrame) -> DataFrame:
    """Runs of consecutive days on which a restaurant has a line."""
    days = items.select("RESTAURANT_ID", F.to_date("CREATION_TIME_UTC").alias("_day"))
    return runs_of_days(days, "_day", ["RESTAURANT_ID"])


def streaks_on_days_off(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Each streak of a restaurant with the runs of days off that it touches, and the days they share."""
    streaks = order_streaks(items).withColumnsRenamed(
        {"FIRST_DAY": "STREAK_FIRST", "LAST_DAY": "STREAK_LAST", "DAYS": "STREAK_DAYS"}
    )
    met = overlap_join(streaks, days_off(date_dim), ("STREAK_FIRST", "STREAK_LAST"), RUN[:2], bucket_seconds=7 * DAY)
    shared = F.datediff(F.least("STREAK_LAST", "LAST_DAY"), F.greatest("STREAK_FIRST", "FIRST_DAY")) + 1
    return met.withColumn("DAYS_SHARED", shared)


def spend_before_orders(items: DataFrame, blank_as_null: bool = False, days: int = SPEND_DAYS) -> DataFrame:
    """Each order of a customer by day, with ROLLING_SPEND, the customer's spend of that day and the ``days`` - 1 before.

    NULL for lines without a time.
    """
    lines = customer_lines(items, blank_as_null)
    spend = rolling_sum(lines, "CUSTOMER_ID", "ORDER_DAY", "SPEND", "ROLLING_SPEND", days)
    orders = lines.select("CUSTOMER_ID", "ORDER_ID", "ORDER_DAY").distinct()
    return orders.join(spend, ["CUSTOMER_ID", "ORDER_DAY"], "left")
