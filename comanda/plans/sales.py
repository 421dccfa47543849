"""Sales trends by day, week and month, and sales by calendar flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import (
    ratio,
    time_of_day,
    time_of_day_label,
    time_of_day_number,
)
from comanda.operators.cleaning import least_rows
from comanda.operators.heavy import heavy_keys
from comanda.plans.shared import with_revenue
from comanda.schemas import GOLD, conform

TIME = "CREATION_TIME_UTC"
TIME_NUMBER = "_time_of_day"
PERIOD_COLUMNS = {
    "DAILY": ("SALES_DATE",),
    "WEEKLY": ("YEAR", "WEEK"),
    "MONTHLY": ("YEAR", "MONTH"),
}


def iso_year(moment: str) -> Column:
    """Year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), F.col(moment)).cast("int")


def with_date_parts(items: DataFrame, iso_weeks: bool = False) -> DataFrame:
    """Add SALES_DATE, YEAR, MONTH, WEEK (ISO number). ``iso_weeks`` makes YEAR the week's own year."""
    return items.withColumns(
        {
            "SALES_DATE": F.to_date(TIME),
            "YEAR": iso_year(TIME) if iso_weeks else F.year(TIME),
            "MONTH": F.month(TIME),
            "WEEK": F.weekofyear(TIME),
        }
    )


def with_time_of_day(items: DataFrame) -> DataFrame:
    return items.withColumn("TIME_OF_DAY", time_of_day(TIME))


def _measures() -> list[Column]:
    return [
        F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"),
        F.sum("ITEM_QUANTITY").alias("ITEMS_SOLD"),
    ]


SHARED = ["RESTAURANT_ID", "ITEM_CATEGORY", TIME_NUMBER]


# What the summaries read.
LINE_COLUMNS = (TIME, "RESTAURANT_ID", "ITEM_CATEGORY", "ORDER_ID", "ITEM_QUANTITY", "ITEM_PRICE")


def _narrow_lines(items: DataFrame) -> DataFrame:
    lines = items.withColumn(TIME_NUMBER, time_of_day_number(TIME)).withColumn(TIME, F.to_date(TIME))
    return lines.select(TIME, *SHARED, "ORDER_ID", "ITEM_QUANTITY", "ITEM_PRICE")


def _sales_lines(items: DataFrame, spread: bool = True) -> DataFrame:
    """The columns that the summaries need, dealt out by all that they share and, if ``spread``, the order.

    That partitioning serves the count of orders of every period, so all summaries of one frame
    read one exchange; the date parts are put on above it to keep the exchange the same. The
    order in the key keeps a busy restaurant or category spread; without it no sums move after the exchange.
    Price and quantity are smaller than the revenue, which is put on above it too, and the day than the time.
    """
    keys = [*SHARED, "ORDER_ID"] if spread else SHARED
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # fixed, so that none is joined to others
    return with_revenue(_narrow_lines(items).repartition(parts, *keys), "TOTAL_REVENUE")


def _has_busy_group(items: DataFrame) -> bool:
    """Whether a restaurant, category and time of day holds so many lines that one task should not take them all."""
    return not heavy_keys(items.withColumn(TIME_NUMBER, time_of_day_number(TIME)), SHARED).isEmpty()


def sales_summary(lines: DataFrame, columns: Sequence[str], period: str) -> DataFrame:
    """Revenue, distinct orders and items per period columns, restaurant, category and time of day.

    As most groups are small, most lines are shuffled; they carry the time of day as a number
    and the label is put on after the aggregation.
    """
    return (
        lines.groupBy(*columns, "RESTAURANT_ID", "ITEM_CATEGORY", TIME_NUMBER)
        .agg(*_measures())
        .select(
            *columns,
            "RESTAURANT_ID",
            "ITEM_CATEGORY",
            time_of_day_label(F.col(TIME_NUMBER)).alias("TIME_OF_DAY"),
            "TOTAL_REVENUE",
            "TOTAL_ORDERS",
            "ITEMS_SOLD",
            F.lit(period).alias("SALES_PERIOD"),
        )
    )


def _summary(lines: DataFrame, period: str, iso_weeks: bool = False) -> DataFrame:
    return sales_summary(with_date_parts(lines, iso_weeks), PERIOD_COLUMNS[period], period)


def sales_daily(items: DataFrame) -> DataFrame:
    return _summary(_sales_lines(items), "DAILY")


def sales_weekly(items: DataFrame, iso_weeks: bool = False) -> DataFrame:
    return _summary(_sales_lines(items), "WEEKLY", iso_weeks)


def sales_monthly(items: DataFrame) -> DataFrame:
    return _summary(_sales_lines(items), "MONTHLY")


def sales_trends(items: DataFrame, iso_weeks: bool = False, *, dealt: bool = False) -> DataFrame:
    """The three summaries in one table; columns a period lacks are NULL.

    One scan and one shuffle of the lines; after it partial sums move only if some group is busy. Runs a job,
    which looks for such groups with a frequent-items sketch. Lines that are ``dealt`` out by restaurant already
    (``staged_by``) are neither searched nor shuffled.
    """
    lines = with_revenue(_narrow_lines(items), "TOTAL_REVENUE") if dealt else _sales_lines(items, _has_busy_group(items))
    trends = (
        _summary(lines, "DAILY")
        .unionByName(_summary(lines, "WEEKLY", iso_weeks), allowMissingColumns=True)
        .unionByName(_summary(lines, "MONTHLY"), allowMissingColumns=True)
        .withColumn("AVG_ORDER_VALUE", ratio("TOTAL_REVENUE", "TOTAL_ORDERS"))
    )
    return conform(trends, GOLD["sales_trends"])


def with_calendar(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Lines with the calendar columns of their day; a day spelled twice in the calendar joins once.

    The calendar is one row per day. Spark broadcasts it when its size is under the session's
    limit and shuffles otherwise.
    """
    calendar = least_rows(date_dim.where(F.col("date_key").isNotNull()), ["date_key"])
    return items.join(calendar, F.to_date(items[TIME]) == calendar["date_key"], "left")


def sales_by_calendar(items: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Revenue, orders and items by weekend and holiday flag."""
    lines = with_revenue(with_calendar(items, date_dim), "TOTAL_REVENUE")
    return lines.groupBy("is_weekend", "is_holiday").agg(*_measures())
