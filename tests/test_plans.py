"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks.workspace import workspace
from comanda.plans import churn, clv, locations, loyalty, pricing, rfm, rollup, sales
from tests.data import items

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ws(spark):
    found = workspace(spark, FOLDER)
    found.items, found.options
    return found


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = {
    "rfm base": lambda ws: rfm.rfm_base(ws.items),
    "clv totals": lambda ws: clv.clv_totals(ws.items, ws.options),
    "churn": lambda ws: churn.churn(ws.items),
    "churn per order": lambda ws: churn.churn(ws.items, per="order"),
    "order gaps": lambda ws: churn.order_gaps(ws.items),
    "loyalty": lambda ws: loyalty.loyalty(ws.items),
    "sales": lambda ws: sales.sales_trends(ws.items),
    "locations": lambda ws: locations.location_metrics(ws.items),
    "retention": lambda ws: locations.location_retention(ws.items),
    "pricing orders": lambda ws: pricing.pricing_orders(ws.items, ws.options),
    "pricing by": lambda ws: pricing.pricing_by(ws.items, ws.options, ["RESTAURANT_ID"]),
}


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_gathers_lines_in_one_task_or_crosses_tables(ws, name):
    plan = plan_of(LAZY[name](ws))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    main = plan.split("Subquery")[0]
    assert "SinglePartition" not in main


def test_churn_is_one_shuffle_without_a_sort_or_join(ws):
    plan = plan_of(churn.churn(ws.items))
    assert len(set(re.findall(r"Exchange hashpartitioning.*plan_id=(\d+)", plan))) == 1
    assert "Join" not in plan and "Sort" not in plan and "Window" not in plan


def test_sales_summaries_share_one_scan_and_one_shuffle_of_the_lines(ws):
    df = sales.sales_trends(ws.items)
    columns = set(re.findall(r"FileScan parquet \[(.*?)\]", plan_of(df)))
    assert len({re.sub(r"#\d+", "", c) for c in columns}) == 1
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet", final)) == 1
    assert len(re.findall(r"ReusedExchange", final)) == 2


def test_no_sums_of_sales_move_unless_a_group_is_busy(spark):
    rows = [dict(ORDER_ID=f"o{n % 700}", RESTAURANT_ID=f"r{n % 30}", ITEM_CATEGORY=f"c{n % 17}",
                 CREATION_TIME_UTC=None if n % 19 == 0 else f"2023-0{1 + n % 6}-0{1 + n % 5} {n % 24:02}:00:00")
            for n in range(3_000)]
    busy = [row | dict(RESTAURANT_ID="r0", ITEM_CATEGORY="c0") if n % 3 == 0 else row for n, row in enumerate(rows)]
    for given, shuffles in ((rows, 1), (busy, 4)):
        lines = items(spark, given)
        found = sales.sales_trends(lines)
        assert len(set(re.findall(r"Exchange hashpartitioning.*plan_id=(\d+)", plan_of(found).split("Subquery")[0]))) >= shuffles
        assert ("Exchange hashpartitioning(RESTAURANT_ID" in plan_of(found)) and plan_of(found).count("ENSURE_REQUIREMENTS") == shuffles - 1
        orders = found.where("SALES_PERIOD = 'MONTHLY'").groupBy("RESTAURANT_ID").agg(F.sum("TOTAL_ORDERS")).collect()
        months = sales.with_time_of_day(sales.with_date_parts(lines))
        keys = ["YEAR", "MONTH", "RESTAURANT_ID", "ITEM_CATEGORY", "TIME_OF_DAY"]
        plain = months.groupBy(*keys).agg(F.count_distinct("ORDER_ID").alias("n")).groupBy("RESTAURANT_ID").agg(F.sum("n")).collect()
        assert sorted(orders) == sorted(plain)


@pytest.mark.parametrize("busy", [False, True])
def test_locations_count_orders_and_times_without_an_expand(spark, busy):
    rows = [dict(ORDER_ID=None if n % 23 == 0 else f"o{n % 300}",
                 RESTAURANT_ID=None if n % 301 == 7 else "r0" if busy and n % 2 else f"r{n % 400}",
                 CREATION_TIME_UTC=None if n % 19 == 0 else f"2023-0{1 + n % 6}-0{1 + n % 5} {n % 24:02}:00:00")
            for n in range(3_000)]
    lines = items(spark, rows)
    found = locations.location_metrics(lines)
    assert "Expand" not in plan_of(found)
    plain = lines.groupBy("RESTAURANT_ID").agg(
        F.count_distinct("ORDER_ID"), F.count_distinct("CREATION_TIME_UTC"), F.min("CREATION_TIME_UTC"), F.max("CREATION_TIME_UTC"))
    got = found.select("RESTAURANT_ID", "TOTAL_ORDERS", "ACTIVE_DAYS", "FIRST_ORDER_DATE", "LAST_ORDER_DATE")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_pricing_join_reuses_the_partitioning_of_its_aggregates(ws, spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pricing.pricing_orders(ws.items, ws.options))
        assert plan.count("Exchange hashpartitioning(ORDER_ID") == 2
        assert "LessThan(OPTION_PRICE,0.00)" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_pricing_by_sums_lines_before_they_meet_their_order(ws, spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pricing.pricing_by(ws.items, ws.options, ["ITEM_CATEGORY"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "collect" not in plan and "map_from_entries" not in plan
    # Whole lines and discounts move by order and line; by order alone only sums do.
    assert plan.count("Exchange hashpartitioning(ORDER_ID") + plan.count("ReusedExchange") >= 4
    by_order = re.findall(r"Exchange hashpartitioning\(ORDER_ID#\d+, \d+\)", plan)
    assert len(by_order) == 2


def test_cube_counts_orders_over_one_expand(ws):
    plan = plan_of(rollup.sales_cube(ws.items)).split("Initial Plan")[0]
    assert plan.count("Expand ") == 1 and "collect_set" not in plan


def test_orders_and_times_of_locations_share_one_scan_and_one_shuffle_of_the_lines(ws):
    found = locations.location_metrics(ws.items)
    found.collect()
    final = plan_of(found).split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1 and final.count("ReusedExchange") == 1


def test_sales_and_locations_shuffle_price_and_quantity_not_the_wider_revenue(ws):
    for found in (sales.sales_trends(ws.items), locations.location_metrics(ws.items)):
        shuffled = re.findall(r"REPARTITION_BY_NUM.*\n.*Project \[(.*)\]", plan_of(found))
        assert shuffled and all("ITEM_PRICE" in columns and "*" not in columns for columns in shuffled)
    assert "as date) AS CREATION_TIME_UTC" in plan_of(sales.sales_trends(ws.items)).split("REPARTITION_BY_NUM")[1]
