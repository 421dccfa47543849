"""Distinct orders that can be summed up: states beside the sales figures, totals over any grouping from them.

A count of distinct orders cannot be added up over groups that share orders. Two states can be merged: a sketch
(HyperLogLog, relative standard error 1.04 / sqrt(2 ** LG_K), 1.6 %), and the exact set of the orders' numbers. Orders are
numbered without gaps in the order of their first time, so the orders of a day lie close together; numbers are kept per
bucket of 32,768 as positions while they are few, and as a bitmap from ``DENSE`` on. No state of a group holds
more than a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comanda.functions import bits
from comanda.operators.ranking import ROWS_PER_BUCKET, VALUES_BEFORE, value_positions
from comanda.plans.sales import TIME, with_time_of_day
from comanda.plans.shared import with_revenue
from comanda.staging import Staged, stage

KEYS = ("SALES_DATE", "RESTAURANT_ID", "ITEM_CATEGORY", "TIME_OF_DAY")
CUBE = ("ITEM_CATEGORY", "RESTAURANT_ID", "SALES_MONTH")
# Size of the sketches as a power of two, and the orders of a bucket from which a bitmap (4 KB) is smaller.
LG_K, DENSE = 12, 1_024


def order_numbers(items: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """ORDER_ID and ORDER_NUMBER, from 0 without gaps by first time and id. Runs jobs.

    Orders are numbered by range, no task sees all of them. NULL is no order.
    """
    firsts = items.where(F.col("ORDER_ID").isNotNull()).groupBy("ORDER_ID").agg(F.min(TIME).alias("_first"))
    placed = stage(firsts.select(F.struct("_first", "ORDER_ID").alias("_order")), "order-times")
    numbered = value_positions(placed, "_order", rows_per_bucket=rows_per_bucket)
    return numbered.select(F.col("_order.ORDER_ID").alias("ORDER_ID"), F.col(VALUES_BEFORE).alias("ORDER_NUMBER"))


def _lines(items: DataFrame) -> DataFrame:
    return with_time_of_day(with_revenue(items, "TOTAL_REVENUE")).withColumn("SALES_DATE", F.to_date(TIME))


def sales_states(items: DataFrame) -> DataFrame:
    """Daily sales with ORDERS_SKETCH in the place of a count of orders."""
    return _lines(items).groupBy(*KEYS).agg(
        F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        F.sum("ITEM_QUANTITY").alias("ITEMS_SOLD"),
        F.hll_sketch_agg("ORDER_ID", LG_K).alias("ORDERS_SKETCH"),
    )


def order_sets(items: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The exact orders of each group of daily sales: ORDER_BUCKET and either POSITIONS or BITS. Runs jobs."""
    numbers = order_numbers(items, rows_per_bucket)
    named = _lines(items).select(*KEYS, "ORDER_ID").distinct().join(numbers, "ORDER_ID")
    return _sets(
        named.select(
            *KEYS,
            F.bitmap_bucket_number("ORDER_NUMBER").alias("ORDER_BUCKET"),
            F.bitmap_bit_position("ORDER_NUMBER").alias("_position"),
        )
    )


def _sets(positions: DataFrame) -> DataFrame:
    """``positions`` are distinct rows. Only groups of ``DENSE`` orders or more get a bitmap while they are gathered."""
    group = [*KEYS, "ORDER_BUCKET"]
    rows = positions.repartition(*group).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    few = rows.where(F.col("_n") < DENSE).groupBy(*group).agg(
        F.array_sort(F.collect_list(F.col("_position").cast("smallint"))).alias("POSITIONS")
    )
    dense = rows.where(F.col("_n") >= DENSE).groupBy(*group).agg(F.bitmap_construct_agg("_position").alias("BITS"))
    return few.unionByName(dense, allowMissingColumns=True)


def _by_month(df: DataFrame, by: Sequence[str]) -> DataFrame:
    parts = {"YEAR": F.year("SALES_DATE"), "MONTH": F.month("SALES_DATE")}
    return df.withColumns({name: parts[name] for name in by if name in parts})


def exact_orders(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TOTAL_ORDERS per ``by`` (columns of the sales, YEAR, MONTH; none for all), from ``order_sets`` alone.

    Sets are merged by words of 64 orders, so a group takes as many rows as it has words, not a bitmap per bucket.
    """
    rows, position = _by_month(sets, by), F.col("_position")
    few = rows.where(F.col("BITS").isNull()).select(*by, "ORDER_BUCKET", F.explode("POSITIONS").alias("_position"))
    few = few.select(*by, "ORDER_BUCKET", bits.word_of(position).alias("_word"), bits.lone_bit(position).alias("_bits"))
    dense = rows.where(F.col("BITS").isNotNull()).select(
        *by, "ORDER_BUCKET", F.posexplode(bits.words(F.col("BITS"))).alias("_word", "_bits")
    )
    merged = few.unionByName(dense).groupBy(*by, "ORDER_BUCKET", "_word").agg(F.bit_or("_bits").alias("_bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("TOTAL_ORDERS"))


def sketched_sales(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TOTAL_REVENUE, ITEMS_SOLD and APPROX_ORDERS per ``by``, from ``sales_states`` alone."""
    return _by_month(states, by).groupBy(*by).agg(
        F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        F.sum("ITEMS_SOLD").alias("ITEMS_SOLD"),
        F.hll_sketch_estimate(F.hll_union_agg("ORDERS_SKETCH")).alias("APPROX_ORDERS"),
    )


def sales_cube(items: DataFrame, by: Sequence[str] = CUBE) -> DataFrame:
    """Sales for every subset of the ``by`` columns: those left out are NULL, and GROUPING_ID has a bit for each.

    Lines are summed per order and ``by`` first, so the subsets are laid out over these rows only. Orders then have a
    row per group, whose number is the count of distinct orders: no set of orders is gathered, and only sums move
    between tasks. A NULL value is a group of its own, told from a left-out column by GROUPING_ID.
    """
    lines = _lines(items).withColumn("SALES_MONTH", F.trunc("SALES_DATE", "month"))
    sums = [F.sum(c).alias(c) for c in ("TOTAL_REVENUE", "ITEM_QUANTITY")]
    per_order = lines.groupBy(*by, "ORDER_ID").agg(*sums)
    subsets = [[c for n, c in enumerate(by) if not left_out >> n & 1] for left_out in range(2 ** len(by))]
    laid = per_order.groupingSets([[*subset, "ORDER_ID"] for subset in subsets], *by, "ORDER_ID")
    # The order is the last column of every subset, so its bit, the lowest, is always 0.
    found = laid.agg(F.shiftright(F.grouping_id(), 1).alias("GROUPING_ID"), *sums)
    return found.groupBy(*by, "GROUPING_ID").agg(
        F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        F.sum("ITEM_QUANTITY").alias("ITEMS_SOLD"),
        F.count("ORDER_ID").alias("TOTAL_ORDERS"),
    )


def staged_sets(items: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> Staged:
    """``order_sets`` written once, for several groupings."""
    return stage(order_sets(items, rows_per_bucket), "order-sets")
