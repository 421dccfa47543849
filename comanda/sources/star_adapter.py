"""Order tables derived from a star schema of orders, lineitem and part.

Turns a generic sales schema into raw order_items, order_item_options and date_dim tables as a
careless source would hand them over: everything is text, some of it no number, time or flag;
values are padded, ids missing or blank, quantities zero; lines come again as exact copies and
as copies that differ in a column; days come twice and in two spellings. Every rule of the
cleaning step and the metrics has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.functions.metrics import first_match


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _line_id() -> Column:
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(p).cast("string") for p in parts])


def order_items_raw(spark: SparkSession, folder: str) -> DataFrame:
    # Orders come last: a sort-merge join then leaves the lines of an order side by side, which makes every layer smaller.
    joined = (
        _table(spark, folder, "lineitem")
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    # Lines come again after the joins, so each is shuffled once.
    copies = F.when(F.col("l_orderkey") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    joined = joined.withColumn("copy", F.explode(copies))
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    odd_lot = F.col("l_orderkey") + F.col("l_partkey")
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    near_copy = (F.col("copy") == 1) & (order % 3 == 0)
    moment = F.expr("timestampadd(MINUTE, o_orderkey * 7919 % 1440, o_orderdate)")
    return joined.select(
        F.when(odd_lot % 499 != 0, _line_id()).alias("LINEITEM_ID"),
        F.col("l_orderkey").cast("string").alias("ORDER_ID"),
        F.col("o_orderpriority").alias("APP_NAME"),
        F.concat(F.lit(" R"), "l_suppkey", F.lit(" ")).alias("RESTAURANT_ID"),
        F.lit(" USD").alias("CURRENCY"),
        F.concat("p_type", F.lit(" ")).alias("ITEM_CATEGORY"),
        F.col("p_name").alias("ITEM_NAME"),
        F.when(odd_lot % 307 == 0, "soon")
        .otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .alias("CREATION_TIME_UTC"),
        first_match(
            (odd_lot % 83 == 0, "n/a"),
            (odd_lot % 79 == 0, "123456789012.50"),
            otherwise=price,
        ).alias("ITEM_PRICE"),
        first_match(
            (near_copy, "1"),
            (odd_lot % 97 == 0, "0"),
            (odd_lot % 89 == 0, F.lit(None).cast("string")),
            (odd_lot % 73 == 0, "some"),
            (odd_lot % 71 == 0, "99999999999"),
            (odd_lot % 7 == 0, F.concat(quantity, F.lit(".0"))),
            otherwise=quantity,
        ).alias("ITEM_QUANTITY"),
        first_match(
            (order % 10 == 0, (1 - customer % 2).cast("string")),
            (customer % 3 == 0, F.lit(None).cast("string")),
            (customer % 19 == 0, "yes"),
            (customer % 13 == 0, "1.0"),
            otherwise=(customer % 2).cast("string"),
        ).alias("IS_LOYALTY"),
        first_match(
            (customer % 7 == 0, F.lit(None).cast("string")),
            (customer % 11 == 0, ""),
            otherwise=F.concat(F.lit("U"), customer),
        ).alias("USER_ID"),
        first_match(
            (customer % 14 == 0, F.lit(None).cast("string")),
            (customer % 5 == 0, "  "),
            otherwise=F.concat(F.lit(" C"), customer),
        ).alias("PRINTED_CARD_NUMBER"),
    )


def order_item_options_raw(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    discounted = lines.where("l_discount >= 0.09")
    rebate = F.col("l_discount").cast("decimal(10,2)") * -100

    def options(rows: DataFrame, group: Column, name: Column, price: Column, quantity: Column):
        return rows.select(
            F.col("l_orderkey").cast("string").alias("ORDER_ID"),
            _line_id().alias("LINEITEM_ID"),
            group.alias("OPTION_GROUP_NAME"),
            name.alias("OPTION_NAME"),
            price.cast("decimal(10,2)").cast("string").alias("OPTION_PRICE"),
            F.concat(quantity.cast("string"), F.lit(".0")).alias("OPTION_QUANTITY"),
        )

    add_ons = options(
        lines.where("l_tax > 0"),
        F.concat("l_returnflag", F.lit(" ")),
        F.col("l_linestatus"),
        F.col("l_tax").cast("decimal(10,2)") * 100,
        1 + F.col("l_linenumber") % 3,
    )
    promotions = options(
        discounted.where("l_orderkey % 3 = 0"),
        F.lit("DISCOUNT"),
        F.lit(" promo"),
        rebate,
        F.lit(1),
    )
    repeated = options(
        discounted.where("l_orderkey % 39 = 0"),
        F.lit("DISCOUNT"),
        F.lit("promo"),
        rebate,
        F.lit(1),
    )
    return add_ons.unionAll(promotions).unionAll(repeated)


def date_dim_raw(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("d")
    christmas = (F.month(day) == 12) & (F.dayofmonth(day) == 25)
    new_year = (F.month(day) == 1) & (F.dayofmonth(day) == 1)
    days = _table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    usual = days.withColumn("spelling", F.date_format(day, "yyyy-MM-dd"))
    again = usual.where(F.dayofmonth(day) % 7 == 0)
    spelled = again.withColumn("spelling", F.date_format(day, "yyyy-M-d"))
    return usual.unionAll(again).unionAll(spelled).select(
        F.col("spelling").alias("date_key"),
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        F.weekofyear(day).cast("string").alias("week"),
        F.concat(F.lit(" "), F.date_format(day, "EEEE")).alias("day_of_week"),
        (F.weekday(day) >= 5).cast("string").alias("is_weekend"),
        (christmas | new_year).cast("string").alias("is_holiday"),
        F.when(christmas, "Christmas ").when(new_year, "New Year").alias("holiday_name"),
    )


READERS = {
    "order_items": order_items_raw,
    "order_item_options": order_item_options_raw,
    "date_dim": date_dim_raw,
}


def raw_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return READERS[table](spark, folder)
