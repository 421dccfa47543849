"""Building blocks of the gold metrics: customers, revenue, the reference date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import (
    customer_id,
    days_since,
    line_revenue,
    null_to_zero,
    option_value,
    spend_period,
)


def with_customer(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Add CUSTOMER_ID and drop the lines that have none."""
    with_id = items.withColumn("CUSTOMER_ID", customer_id(blank_as_null))
    return with_id.where(F.col("CUSTOMER_ID").isNotNull())


def customer_lines(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """The lines of known customers in the form the customer metrics aggregate: spend, times, day."""
    time = F.col("CREATION_TIME_UTC")
    return with_customer(items, blank_as_null).select(
        "CUSTOMER_ID",
        "ORDER_ID",
        "IS_LOYALTY",
        F.to_date(time).alias("ORDER_DAY"),
        line_revenue().alias("SPEND"),
        time.alias("FIRST_TIME"),
        time.alias("LAST_TIME"),
        time.isNotNull().cast("bigint").alias("TIMES"),
    )


def customer_orders(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """``customer_lines`` summed up per order and day, columns and meaning unchanged.

    Segmentation, churn and loyalty give the same results from either.
    """
    return (
        customer_lines(items, blank_as_null)
        .groupBy("CUSTOMER_ID", "ORDER_ID", "IS_LOYALTY", "ORDER_DAY")
        .agg(
            F.sum("SPEND").alias("SPEND"),
            F.min("FIRST_TIME").alias("FIRST_TIME"),
            F.max("LAST_TIME").alias("LAST_TIME"),
            F.sum("TIMES").alias("TIMES"),
        )
    )


# The values of IS_LOYALTY that a customer's lines may have, by the suffix of their columns in ``customer_totals``.
FLAGS: dict[str, bool | None] = {"LOYAL": True, "PLAIN": False, "UNKNOWN": None}
PERIODS = ("PREVIOUS", "RECENT")


def customer_totals(items: DataFrame, reference: DataFrame | None = None, blank_as_null: bool = False) -> DataFrame:
    """One row per customer with all that segmentation, churn and loyalty tell of one.

    Lines are summed per customer and order, by loyalty flag and spend period, and then per customer, so no count of
    distinct orders is left to any of the three. A customer with many lines is dealt out by order.
    """
    lines = customer_lines(items, blank_as_null)
    now = today(lines.select(F.col("LAST_TIME").alias("CREATION_TIME_UTC")), reference)
    lines = lines.withColumn("_period", spend_period(days_since("ORDER_DAY", now)))
    flagged = {flag: "IS_LOYALTY IS " + {True: "TRUE", False: "FALSE", None: "NULL"}[value] for flag, value in FLAGS.items()}
    spent = [f"SPEND_{name}" for name in (*FLAGS, *PERIODS)]
    per_order = lines.groupBy("CUSTOMER_ID", "ORDER_ID").agg(
        *[F.expr(f"sum(SPEND) FILTER (WHERE {known}) AS SPEND_{flag}") for flag, known in flagged.items()],
        *[F.expr(f"sum(SPEND) FILTER (WHERE _period = '{p}') AS SPEND_{p}") for p in PERIODS],
        *[F.expr(f"bool_or({known}) AS HAS_{flag}") for flag, known in flagged.items()],
        F.count("_period").alias("IN_PERIOD"),
        F.min("FIRST_TIME").alias("FIRST_TIME"),
        F.max("LAST_TIME").alias("LAST_TIME"),
        F.sum("TIMES").alias("TIMES"),
    )
    return per_order.groupBy("CUSTOMER_ID").agg(
        F.count("ORDER_ID").alias("ORDERS"),
        *[F.expr(f"count(ORDER_ID) FILTER (WHERE HAS_{flag}) AS ORDERS_{flag}") for flag in FLAGS],
        *[F.expr(f"bool_or(HAS_{flag}) AS HAS_{flag}") for flag in FLAGS],
        *[F.sum(c).cast("decimal(38,2)").alias(c) for c in spent],
        F.sum("IN_PERIOD").alias("IN_PERIOD"),
        F.min("FIRST_TIME").alias("FIRST_TIME"),
        F.max("LAST_TIME").alias("LAST_TIME"),
        F.sum("TIMES").alias("TIMES"),
    )


def with_revenue(items: DataFrame, alias: str) -> DataFrame:
    return items.withColumn(alias, line_revenue())


def option_revenue(options: DataFrame) -> DataFrame:
    """Option revenue per order line; discounts count as negative revenue."""
    return options.groupBy("ORDER_ID", "LINEITEM_ID").agg(
        F.sum(option_value()).alias("OPTION_REVENUE")
    )


def order_line_revenue(items: DataFrame, options: DataFrame) -> DataFrame:
    """Lines with ITEM_REVENUE, OPTION_REVENUE (0 if none) and their sum TOTAL_LINE_REVENUE."""
    joined = with_revenue(items, "ITEM_REVENUE").join(
        option_revenue(options), ["ORDER_ID", "LINEITEM_ID"], "left"
    )
    return joined.withColumn("OPTION_REVENUE", null_to_zero(F.col("OPTION_REVENUE"))).withColumn(
        "TOTAL_LINE_REVENUE", F.col("ITEM_REVENUE") + F.col("OPTION_REVENUE")
    )


def reference_date(customer_lines: DataFrame) -> DataFrame:
    """One row: the last order time, which stands for "today"."""
    return customer_lines.agg(F.max("CREATION_TIME_UTC").alias("REFERENCE_DATE"))


def today(customer_lines: DataFrame, reference: DataFrame | None) -> Column:
    """The reference date as a scalar subquery: a map-side max, nothing joined or collected."""
    return (reference_date(customer_lines) if reference is None else reference).scalar()
