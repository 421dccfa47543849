"""Pricing and discount effectiveness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comanda.functions.metrics import discount_status, line_revenue, null_to_zero
from comanda.schemas import GOLD, conform

CENTS = 2


def _discount(use_quantity: bool) -> Column:
    amount = -F.col("OPTION_PRICE")
    return amount * F.col("OPTION_QUANTITY") if use_quantity else amount


def _discounts(options: DataFrame, keys: Sequence[str], use_quantity: bool) -> DataFrame:
    return (
        options.where(F.col("OPTION_PRICE") < 0)
        .groupBy(*keys)
        .agg(F.round(F.sum(_discount(use_quantity)), CENTS).alias("DISCOUNT_AMOUNT"))
    )


def order_discounts(options: DataFrame, use_quantity: bool = False) -> DataFrame:
    """Discount per order, from the options with a negative price.

    The price alone counts unless ``use_quantity``.
    """
    return _discounts(options, ["ORDER_ID"], use_quantity)


def order_gross(items: DataFrame) -> DataFrame:
    return items.groupBy("ORDER_ID").agg(
        F.round(F.sum(line_revenue()), CENTS).alias("GROSS_REVENUE")
    )


def pricing_orders(items: DataFrame, options: DataFrame, use_quantity: bool = False) -> DataFrame:
    """Gross, discount, status and net of every order that has a line.

    Both sides are aggregated by ORDER_ID, so the join reuses their partitioning.
    """
    joined = order_gross(items).join(order_discounts(options, use_quantity), "ORDER_ID", "left")
    amount = null_to_zero(F.col("DISCOUNT_AMOUNT"))
    return joined.withColumn("DISCOUNT_AMOUNT", amount).withColumns(
        {
            "DISCOUNT_STATUS": discount_status(F.col("DISCOUNT_AMOUNT")),
            "NET_REVENUE": F.round(F.col("GROSS_REVENUE") - F.col("DISCOUNT_AMOUNT"), CENTS),
        }
    )


def pricing(items: DataFrame, options: DataFrame, use_quantity: bool = False) -> DataFrame:
    """Totals per discount status, mean order value and share of the net revenue.

    The orders are unique at this point, so counting ids is counting distinct ids. The share is a
    window over the two status rows.
    """
    per_status = (
        pricing_orders(items, options, use_quantity)
        .groupBy("DISCOUNT_STATUS")
        .agg(
            F.count("ORDER_ID").alias("TOTAL_ORDERS"),
            *[
                F.round(F.sum(c), CENTS).alias(c)
                for c in ("GROSS_REVENUE", "DISCOUNT_AMOUNT", "NET_REVENUE")
            ],
        )
    )
    total = F.sum("NET_REVENUE").over(Window.partitionBy())
    share = F.try_divide(F.col("NET_REVENUE"), total) * 100
    result = per_status.withColumns(
        {
            "AVG_ORDER_VALUE": F.round(
                F.try_divide(F.col("NET_REVENUE"), F.col("TOTAL_ORDERS")), CENTS
            ),
            "REVENUE_PERCENTAGE": F.round(share, CENTS),
        }
    )
    return conform(result, GOLD["pricing_discount_effectiveness"])


def pricing_by(
    items: DataFrame, options: DataFrame, columns: Sequence[str], use_quantity: bool = False
) -> DataFrame:
    """Net revenue by line columns (category, restaurant) and the discount status of the order.

    Net of a line is its revenue less its own discounts. Lines meet their discounts by order and line, keys that
    no order makes hot, and are summed per order and columns before they meet the order's status; an order with a
    third of all lines has a row per combination of the columns by then.
    """
    by_line = _discounts(options, ["ORDER_ID", "LINEITEM_ID"], use_quantity)
    by_order = by_line.groupBy("ORDER_ID").agg(F.sum("DISCOUNT_AMOUNT").alias("_of_order"))
    lines = items.select("ORDER_ID", "LINEITEM_ID", *columns, line_revenue().alias("_gross"))
    net = F.col("_gross") - null_to_zero(F.col("DISCOUNT_AMOUNT"))
    per_order = (
        lines.join(by_line, ["ORDER_ID", "LINEITEM_ID"], "left")
        .groupBy("ORDER_ID", *columns)
        .agg(F.sum(net).alias("_net"))
    )
    status = discount_status(null_to_zero(F.col("_of_order"))).alias("DISCOUNT_STATUS")
    return (
        per_order.join(by_order, "ORDER_ID", "left")
        .select(*columns, status, "_net")
        .groupBy(*columns, "DISCOUNT_STATUS")
        .agg(F.sum("_net").alias("NET_REVENUE"))
    )
