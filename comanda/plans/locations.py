"""Performance of restaurant locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import ratio
from comanda.operators.heavy import heavy_keys
from comanda.operators.ranking import ROWS_PER_BUCKET, global_dense_rank
from comanda.plans.shared import with_customer, with_revenue
from comanda.schemas import GOLD, conform
from comanda.staging import stage

TIME = "CREATION_TIME_UTC"
DAYS_PER_WEEK = 7
# What the figures read.
LINE_COLUMNS = ("RESTAURANT_ID", "ORDER_ID", TIME, "ITEM_PRICE", "ITEM_QUANTITY")


def has_busy_restaurant(items: DataFrame) -> bool:
    """Whether a restaurant holds so many lines that one task should not take them all. Runs a job."""
    return not heavy_keys(items, ["RESTAURANT_ID"]).isEmpty()


def _dealt_lines(items: DataFrame) -> DataFrame:
    keys = ["RESTAURANT_ID", "ORDER_ID", TIME] if has_busy_restaurant(items) else ["RESTAURANT_ID"]
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # fixed, so that none is joined to others
    return items.select(*LINE_COLUMNS).repartition(parts, *keys)


def location_metrics(items: DataFrame, day_grain: bool = False, *, dealt: bool = False) -> DataFrame:
    """Totals and rates per restaurant.

    ACTIVE_DAYS counts distinct order times as they stand; ``day_grain`` counts calendar days.
    Lines are dealt out by restaurant, and by order and time too if a restaurant is busy. Orders and times are
    counted by two aggregates over that one shuffle. Spark shares it only if both read the same columns, so the days
    carry lines and revenue as well; neither changes a figure. Runs a job, which looks for busy restaurants. Lines that
    are ``dealt`` out by restaurant already (``staged_by``) are neither searched nor shuffled.
    """
    sales_date = F.to_date(TIME) if day_grain else F.col(TIME)
    lines = items.select(*LINE_COLUMNS) if dealt else _dealt_lines(items)
    lines = with_revenue(lines, "TOTAL_REVENUE")  # above the shuffle: price and quantity are smaller
    orders = (
        lines.groupBy("RESTAURANT_ID", "ORDER_ID")
        .agg(F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"), F.min(TIME).alias("_first"), F.max(TIME).alias("_last"))
        .groupBy("RESTAURANT_ID")
        .agg(
            F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
            F.count("ORDER_ID").alias("TOTAL_ORDERS"),
            F.min("_first").alias("FIRST_ORDER_DATE"),
            F.max("_last").alias("LAST_ORDER_DATE"),
        )
    )
    days = (
        lines.groupBy(F.col("RESTAURANT_ID").alias("_restaurant"), sales_date.alias("_day"))
        .agg(F.count("ORDER_ID").alias("_lines"), F.sum("TOTAL_REVENUE").alias("_revenue"))
        .groupBy("_restaurant")
        .agg(F.count("_day").alias("ACTIVE_DAYS"), F.sum("_lines").alias("_lines"), F.sum("_revenue").alias("_revenue"))
    )
    per_location = orders.join(days, F.col("RESTAURANT_ID").eqNullSafe(F.col("_restaurant"))).select(
        "RESTAURANT_ID",
        F.coalesce("TOTAL_REVENUE", "_revenue").alias("TOTAL_REVENUE"),
        F.least("TOTAL_ORDERS", "_lines").alias("TOTAL_ORDERS"),
        "ACTIVE_DAYS",
        "FIRST_ORDER_DATE",
        "LAST_ORDER_DATE",
    )
    weeks = ratio("ACTIVE_DAYS", F.lit(DAYS_PER_WEEK))
    return per_location.withColumns(
        {
            "ORDERS_PER_DAY": ratio("TOTAL_ORDERS", "ACTIVE_DAYS"),
            "ACTIVE_WEEKS": weeks,
            "ORDERS_PER_WEEK": ratio(F.col("TOTAL_ORDERS"), weeks),
            "AVG_ORDER_VALUE": ratio("TOTAL_REVENUE", "TOTAL_ORDERS"),
        }
    )


def locations(
    items: DataFrame, day_grain: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET, *, dealt: bool = False
) -> DataFrame:
    """Location metrics with REVENUE_RANK, the dense rank by revenue, highest first."""
    metrics = stage(location_metrics(items, day_grain, dealt=dealt), "locations")
    ranked = global_dense_rank(metrics, "TOTAL_REVENUE", "REVENUE_RANK", rows_per_bucket)
    return conform(ranked, GOLD["top_performing_locations"])


def location_retention(items: DataFrame) -> DataFrame:
    """Share of a location's customers, in percent, with at least two orders there.

    Two orders differ exactly when the least and the greatest order id do, which one aggregate
    per location and customer settles without a distinct count.
    """
    visits = (
        with_customer(items)
        .groupBy("RESTAURANT_ID", "CUSTOMER_ID")
        .agg((F.min("ORDER_ID") != F.max("ORDER_ID")).alias("_came_back"))
    )
    return (
        visits.groupBy("RESTAURANT_ID")
        .agg(F.count(F.lit(1)).alias("CUSTOMERS"), F.count_if("_came_back").alias("RETURNING"))
        .withColumn("CUSTOMER_RETENTION_RATE", ratio("RETURNING", "CUSTOMERS") * 100.0)
    )
