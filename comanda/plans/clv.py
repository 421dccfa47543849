"""Customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import clv_segment
from comanda.operators.ranking import ROWS_PER_BUCKET, global_percent_rank
from comanda.plans.shared import order_line_revenue, with_customer
from comanda.schemas import GOLD, conform
from comanda.staging import stage


# The ids by which lines and options meet, and what is read of an option.
KEYS = ("ORDER_ID", "LINEITEM_ID")
OPTION_COLUMNS = (*KEYS, "OPTION_PRICE", "OPTION_QUANTITY")


def value_lines(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """The lines of known customers in the columns that the totals read."""
    return with_customer(items, blank_as_null).select("CUSTOMER_ID", *KEYS, "ITEM_PRICE", "ITEM_QUANTITY")


def totals_of(lines: DataFrame, options: DataFrame) -> DataFrame:
    """``clv_totals`` from ``value_lines``."""
    return (
        order_line_revenue(lines, options)
        .groupBy("CUSTOMER_ID")
        .agg(F.sum("TOTAL_LINE_REVENUE").alias("CUSTOMER_LIFETIME_VALUE"))
    )


def clv_totals(items: DataFrame, options: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Revenue per customer, options and discounts included.

    The customer is settled before the join, so the join moves three columns per line and no
    line without a customer.
    """
    return totals_of(value_lines(items, blank_as_null), options)


def _ranked(totals: DataFrame, rows_per_bucket: int) -> DataFrame:
    return global_percent_rank(stage(totals, "clv"), "CUSTOMER_LIFETIME_VALUE", "PERCENT_RANK", rows_per_bucket)


def clv_ranked(
    items: DataFrame, options: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    return _ranked(clv_totals(items, options), rows_per_bucket)


def clv_of(lines: DataFrame, options: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``clv`` from ``value_lines``; neither side is shuffled if both are dealt out by ``KEYS`` (``staged_by``)."""
    return _segmented(_ranked(totals_of(lines, options), rows_per_bucket))


def clv(
    items: DataFrame, options: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    return _segmented(clv_ranked(items, options, rows_per_bucket))


def _segmented(ranked: DataFrame) -> DataFrame:
    segmented = ranked.withColumn("CLV_SEGMENT", clv_segment(F.col("PERCENT_RANK")))
    return conform(segmented, GOLD["customer_lifetime_value"])
