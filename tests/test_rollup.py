"""Totals of distinct orders from stored states alone."""

import pytest
from pyspark.sql import functions as F

from comanda.plans import rollup
from comanda.staging import stage
from tests.data import items


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        dict(ORDER_ID=None if n % 11 == 0 else f"o{n % 90}", RESTAURANT_ID=f"r{n % 4}", ITEM_CATEGORY=f"c{n % 3}",
             CREATION_TIME_UTC=None if n % 17 == 0 else f"2023-0{1 + n % 6}-0{1 + n % 5} {n % 24:02}:00:00")
        for n in range(400)
    ]
    return stage(items(spark, rows), "lines").df


def counts(df, by):
    return {tuple(r[c] for c in by): r["TOTAL_ORDERS"] for r in df.collect()}


@pytest.mark.parametrize("dense", [2, 1024])
@pytest.mark.parametrize("by", [[], ["RESTAURANT_ID"], ["YEAR", "MONTH", "ITEM_CATEGORY"], list(rollup.KEYS)])
def test_exact_orders(lines, monkeypatch, dense, by):
    monkeypatch.setattr(rollup, "DENSE", dense)
    found = counts(rollup.exact_orders(rollup.staged_sets(lines, rows_per_bucket=20).df, by), by)
    parts = {"SALES_DATE": F.to_date("CREATION_TIME_UTC"), "YEAR": F.year("CREATION_TIME_UTC"), "MONTH": F.month("CREATION_TIME_UTC")}
    named = rollup._lines(lines).withColumns({k: v for k, v in parts.items() if k in by})
    plain = named.where("ORDER_ID is not null").groupBy(*by).agg(F.count_distinct("ORDER_ID").alias("TOTAL_ORDERS"))
    assert found == counts(plain, by)


def test_only_dense_groups_hold_a_bitmap(spark, lines, monkeypatch):
    plan = rollup.exact_orders(stage(rollup.order_sets(lines), "sets").df, ["RESTAURANT_ID"])._jdf.queryExecution().toString()
    assert "bitmap_or_agg" not in plan and "bitmap_construct_agg" not in plan  # a group keeps no bitmap while sets are merged
    at = dict.fromkeys(rollup.KEYS, "x") | {"SALES_DATE": None}
    rows = [at | {"ORDER_BUCKET": b, "_position": p} for b, n in ((1, 3), (2, 9)) for p in range(0, 40 * n, 40)]
    monkeypatch.setattr(rollup, "DENSE", 5)
    ddl = "SALES_DATE date, RESTAURANT_ID string, ITEM_CATEGORY string, TIME_OF_DAY string, ORDER_BUCKET bigint, _position bigint"
    sets = rollup._sets(spark.createDataFrame(rows, ddl))
    found = {r.ORDER_BUCKET: r for r in sets.collect()}
    assert found[1].POSITIONS == [0, 40, 80] and found[1].BITS is None
    assert found[2].POSITIONS is None and sum(b.bit_count() for b in found[2].BITS) == 9
    assert rollup.exact_orders(sets).first().TOTAL_ORDERS == 12


def test_numbers_have_no_gaps_and_follow_time(lines):
    found = rollup.order_numbers(lines, rows_per_bucket=20).collect()
    assert sorted(r.ORDER_NUMBER for r in found) == list(range(len(found)))
    first = {r.ORDER_ID: r.t for r in lines.groupBy("ORDER_ID").agg(F.min("CREATION_TIME_UTC").alias("t")).collect()}
    in_order = [first[r.ORDER_ID] for r in sorted(found, key=lambda r: r.ORDER_NUMBER)]
    known = [t for t in in_order if t is not None]
    assert known == sorted(known) and in_order[: len(in_order) - len(known)] == [None] * (len(in_order) - len(known))


def test_sketches_merge_within_their_error(spark):
    many = spark.range(60_000).select(
        F.concat(F.lit("o"), F.col("id") % 20_000).alias("ORDER_ID"), F.lit(2).alias("ITEM_QUANTITY"),
        F.lit(1).cast("decimal(10,2)").alias("ITEM_PRICE"), F.concat(F.lit("r"), F.col("id") % 7).alias("RESTAURANT_ID"),
        F.lit("c").alias("ITEM_CATEGORY"), F.timestamp_seconds(F.col("id") * 1000).alias("CREATION_TIME_UTC"))
    found = rollup.sketched_sales(rollup.sales_states(many)).first()
    assert (found.TOTAL_REVENUE, found.ITEMS_SOLD) == (120_000, 120_000)
    assert abs(found.APPROX_ORDERS - 20_000) <= 4 * 0.01625 * 20_000


def test_no_lines(lines):
    none = lines.limit(0)
    assert rollup.exact_orders(rollup.order_sets(none)).first().TOTAL_ORDERS == 0
    assert rollup.sketched_sales(rollup.sales_states(none), ["RESTAURANT_ID"]).count() == 0


def test_cube_tells_nulls_from_left_out_columns(spark):
    rows = [dict(ORDER_ID=o, RESTAURANT_ID=r, ITEM_CATEGORY=c) for o, r, c in
            [("a", "r1", None), ("a", "r1", "x"), ("b", None, "x"), ("b", "r1", "x"), (None, "r1", "x")]]
    found = {(r.ITEM_CATEGORY, r.RESTAURANT_ID, r.GROUPING_ID): (r.TOTAL_ORDERS, r.ITEMS_SOLD)
             for r in rollup.sales_cube(items(spark, rows), ["ITEM_CATEGORY", "RESTAURANT_ID"]).collect()}
    assert found == {
        (None, None, 3): (2, 5), ("x", None, 1): (2, 4), (None, None, 1): (1, 1), (None, "r1", 2): (2, 4),
        (None, None, 2): (1, 1), (None, "r1", 0): (1, 1), ("x", "r1", 0): (2, 3), ("x", None, 0): (1, 1),
    }
