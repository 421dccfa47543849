"""Loyalty-programme impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.functions.metrics import loyalty_status, ratio
from comanda.operators.asof import asof_join
from comanda.plans.shared import FLAGS, customer_lines, with_customer
from comanda.schemas import GOLD, conform


def base_of(facts: DataFrame) -> DataFrame:
    """Spend and distinct orders per customer and loyalty flag; both flags give two rows.

    ``facts`` are ``customer_lines`` or ``customer_orders``.
    """
    return (
        facts.groupBy("CUSTOMER_ID", "IS_LOYALTY")
        .agg(F.sum("SPEND").alias("TOTAL_SPEND"), F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"))
        .withColumn("TOTAL_SPEND", F.col("TOTAL_SPEND").cast("decimal(31,2)"))
    )


def loyalty_base(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    return base_of(customer_lines(items, blank_as_null))


def loyalty_of(facts: DataFrame) -> DataFrame:
    return _impact(base_of(facts))


def loyalty_of_totals(totals: DataFrame) -> DataFrame:
    """``loyalty`` from ``customer_totals``: a row for each flag that a customer's lines have."""
    of_flag = [
        F.struct(
            F.lit(value).cast("boolean").alias("IS_LOYALTY"),
            F.col(f"SPEND_{flag}").cast("decimal(31,2)").alias("TOTAL_SPEND"),
            F.col(f"ORDERS_{flag}").alias("TOTAL_ORDERS"),
            F.col(f"HAS_{flag}").alias("_has"),
        )
        for flag, value in FLAGS.items()
    ]
    rows = totals.select("CUSTOMER_ID", F.explode(F.array(*of_flag)).alias("_one")).select("CUSTOMER_ID", "_one.*")
    return _impact(rows.where("_has").drop("_has"))


def _impact(base: DataFrame) -> DataFrame:
    impact = base.withColumns(
        {
            "AVG_ORDER_VALUE": ratio("TOTAL_SPEND", "TOTAL_ORDERS"),
            "LOYALTY_STATUS": loyalty_status(F.col("IS_LOYALTY")),
            "LIFETIME_VALUE": F.col("TOTAL_SPEND"),
        }
    )
    return conform(impact, GOLD["loyalty_program_impact"])


def loyalty(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    return loyalty_of(customer_lines(items, blank_as_null))


def loyalty_before_orders(items: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Each order of a customer with its first time and LOYALTY_BEFORE, the flag of the last line before that time.

    NULL where the customer has no earlier line. Of several lines at one time a loyal one counts.
    """
    lines = with_customer(items, blank_as_null)
    orders = lines.groupBy("CUSTOMER_ID", "ORDER_ID").agg(F.min("CREATION_TIME_UTC").alias("FIRST_TIME"))
    flags = lines.select("CUSTOMER_ID", F.col("CREATION_TIME_UTC").alias("FIRST_TIME"), "IS_LOYALTY")
    return asof_join(orders, flags, "CUSTOMER_ID", "FIRST_TIME", "IS_LOYALTY", "LOYALTY_BEFORE", strict=True)
