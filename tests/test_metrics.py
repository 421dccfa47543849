import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from comanda.functions.metrics import time_of_day
from comanda.plans import churn, clv, locations, loyalty, pricing, rfm, sales, shared
from tests.data import T0, by_key, items, options


def at(days_ago, hour=12):
    day = dt.datetime(2023, 6, 30, hour) - dt.timedelta(days=days_ago)
    return day.strftime("%Y-%m-%d %H:%M:%S")


def test_customer_ids(spark):
    df = items(spark, [dict(USER_ID=""), dict(USER_ID=None, PRINTED_CARD_NUMBER="c"),
                       dict(USER_ID=None), dict(USER_ID=" ", PRINTED_CARD_NUMBER="c")])
    ids = lambda fixed: sorted(r["CUSTOMER_ID"] for r in shared.with_customer(df, fixed).collect())
    assert ids(False) == ["", " ", "c"]
    assert ids(True) == ["c", "c"]


def test_hours_of_the_day(spark):
    hours = [0, 5, 6, 11, 12, 16, 17, 20, 21, 23]
    df = items(spark, [dict(CREATION_TIME_UTC=at(0, h)) for h in hours] + [dict(CREATION_TIME_UTC=None)])
    labels = [r[0] for r in df.orderBy("CREATION_TIME_UTC").select(time_of_day("CREATION_TIME_UTC")).collect()]
    assert labels == ["Night", "Late Night", "Late Night", "Morning", "Morning", "Afternoon",
                      "Afternoon", "Evening", "Evening", "Night", "Night"]


def test_week_of_new_year(spark):
    df = items(spark, [dict(CREATION_TIME_UTC="2023-01-01 10:00:00")])
    plain, own = sales.sales_weekly(df).first(), sales.sales_weekly(df, iso_weeks=True).first()
    assert (plain["YEAR"], plain["WEEK"]) == (2023, 52)
    assert (own["YEAR"], own["WEEK"]) == (2022, 52)
    both = {r["SALES_PERIOD"]: r["YEAR"] for r in sales.sales_trends(df, iso_weeks=True).collect()}
    assert both == {"DAILY": None, "WEEKLY": 2022, "MONTHLY": 2023}


def test_sales_periods_keep_lines_without_a_time(spark):
    df = items(spark, [dict(CREATION_TIME_UTC=None), dict(), dict(ORDER_ID="o2", ITEM_QUANTITY=3)])
    trends = sales.sales_trends(df)
    totals = {r["SALES_PERIOD"]: (r["revenue"], r["items"]) for r in trends.groupBy("SALES_PERIOD")
              .agg(F.sum("TOTAL_REVENUE").alias("revenue"), F.sum("ITEMS_SOLD").alias("items")).collect()}
    assert totals == {p: (Decimal("50.00"), 5) for p in ("DAILY", "WEEKLY", "MONTHLY")}
    assert trends.count() == 6


def test_churn_limits(spark):
    rows = [dict(USER_ID="now", CREATION_TIME_UTC=at(0, 23))]
    rows += [dict(USER_ID=f"d{d}", CREATION_TIME_UTC=at(d, 1)) for d in (45, 46, 90, 91, 180, 181)]
    got = by_key(churn.churn(items(spark, rows)))
    status = {k: r["CHURN_STATUS"] for k, r in got.items()}
    assert status == {"now": "Active", "d45": "Active", "d46": "At Risk", "d90": "At Risk",
                      "d91": "High Risk", "d180": "High Risk", "d181": "High Risk"}
    spend = {k: (r["PREVIOUS_SPEND"], r["RECENT_SPEND"]) for k, r in got.items()}
    ten, zero = Decimal("10.00"), Decimal("0.00")
    assert spend["d90"] == (zero, ten) and spend["d91"] == (ten, zero)
    assert spend["d180"] == (ten, zero) and spend["d181"] == (None, None)
    assert got["d91"]["SPEND_CHANGE_PERCENT"] == -100.0
    assert got["d90"]["SPEND_CHANGE_PERCENT"] == 0.0
    assert got["d181"]["SPEND_CHANGE_PERCENT"] is None


def test_no_previous_period_at_all(spark):
    row = churn.churn(items(spark, [dict()])).first()
    assert row["PREVIOUS_SPEND"] == 0 and row["SPEND_CHANGE_PERCENT"] == 0.0


def test_customer_without_times(spark):
    df = items(spark, [dict(USER_ID="a", CREATION_TIME_UTC=None), dict(USER_ID="b")])
    row = by_key(churn.churn(df))["a"]
    assert row["CHURN_STATUS"] == "Active" and row["DAYS_SINCE_LAST_ORDER"] is None
    assert row["RECENT_SPEND"] is None
    assert by_key(rfm.rfm(df))["a"]["R_SCORE"] == 5


def test_gaps_by_line_and_by_order(spark):
    df = items(spark, [
        dict(ORDER_ID="o1", CREATION_TIME_UTC=at(10)), dict(ORDER_ID="o1", CREATION_TIME_UTC=at(10)),
        dict(ORDER_ID="o2", CREATION_TIME_UTC=at(4)), dict(ORDER_ID="o3", CREATION_TIME_UTC=None),
        dict(USER_ID="once"),
    ])
    assert {k: r["AVG_ORDER_GAP_DAYS"] for k, r in by_key(churn.avg_gap(df)).items()} == {
        "u1": 3.0, "once": None}
    per_order = by_key(churn.avg_gap(df, per="order"))
    assert per_order["u1"]["AVG_ORDER_GAP_DAYS"] == 6.0
    assert by_key(churn.churn(df, per="order"))["u1"]["AVG_ORDER_GAP_DAYS"] == 6.0
    with pytest.raises(ValueError):
        churn.churn(df, per="week")


def test_order_gaps_equal_a_lag_with_a_hot_customer_and_a_hot_time(spark):
    rows = [
        dict(USER_ID="hot" if i % 3 == 0 else f"u{i % 7}", ORDER_ID=f"o{i % 40}",
             CREATION_TIME_UTC=None if i % 29 == 0 else
             at(1) if i % 5 == 0 else at(i % 60, i * 7 % 24))
        for i in range(900)
    ]
    df = items(spark, rows)
    previous = F.lag("CREATION_TIME_UTC").over(
        Window.partitionBy("CUSTOMER_ID").orderBy("CREATION_TIME_UTC", "ORDER_ID", "LINEITEM_ID"))
    expected = shared.with_customer(df).withColumn("p", previous).select(
        "LINEITEM_ID", "p", F.datediff("CREATION_TIME_UTC", "p").alias("g"))
    got = churn.order_gaps(df)
    assert sorted(map(str, got.select("LINEITEM_ID", F.col("PREVIOUS_ORDER_DATE").alias("p"),
                                      F.col("ORDER_GAP_DAYS").alias("g")).collect())) == sorted(
        map(str, expected.collect()))
    means = got.groupBy("CUSTOMER_ID").agg(F.avg("ORDER_GAP_DAYS").alias("AVG_ORDER_GAP_DAYS"))
    assert sorted(means.collect()) == sorted(churn.avg_gap(df).collect())


def test_combined_churn_equals_its_parts(spark):
    rows = [dict(USER_ID=f"u{i % 9}", ORDER_ID=f"o{i}", CREATION_TIME_UTC=at(i * 11 % 400),
                 ITEM_PRICE=f"{i}.25") for i in range(200)]
    df = items(spark, rows)
    parts = churn.last_order(df).join(churn.avg_gap(df), "CUSTOMER_ID", "left").join(
        churn.spend_change(df), "CUSTOMER_ID", "left")
    whole = churn.churn(df)
    columns = [c for c in whole.columns if c != "CHURN_STATUS"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(
        map(str, parts.select(columns).collect()))


def test_clv_counts_options_and_rfm_does_not(spark):
    df = items(spark, [dict(), dict(USER_ID="u2", ORDER_ID="o2"), dict(USER_ID=None)])
    extra = options(spark, [dict(OPTION_QUANTITY=3), dict(OPTION_PRICE="-2.00"),
                            dict(ORDER_ID="gone", LINEITEM_ID="gone")])
    value = {k: r["CUSTOMER_LIFETIME_VALUE"] for k, r in by_key(clv.clv(df, extra)).items()}
    assert value == {"u1": Decimal("11.00"), "u2": Decimal("10.00")}
    assert {r["MONETARY"] for r in rfm.rfm(df).collect()} == {Decimal("10.00")}


def test_unknown_revenue_ranks_first(spark):
    df = items(spark, [dict(USER_ID="a", ITEM_PRICE=None), dict(USER_ID="b"), dict(USER_ID="c")])
    got = by_key(clv.clv(df, options(spark, [])))
    assert got["a"]["CUSTOMER_LIFETIME_VALUE"] is None
    assert got["a"]["PERCENT_RANK"] == 0.0 and got["a"]["CLV_SEGMENT"] == "Low CLV"
    assert got["b"]["PERCENT_RANK"] == 0.5


def test_both_paths_of_the_ranked_metrics_agree(spark):
    rows = [dict(USER_ID=f"u{i % 37}", ORDER_ID=f"o{i % 90}", RESTAURANT_ID=f"r{i % 23}",
                 CREATION_TIME_UTC=at(i * 13 % 300), ITEM_PRICE=f"{i % 11}.50") for i in range(400)]
    df, extra = items(spark, rows), options(spark, [dict()])
    for build in (lambda n: rfm.rfm(df, rows_per_bucket=n), lambda n: clv.clv(df, extra, n),
                  lambda n: locations.locations(df, rows_per_bucket=n)):
        assert sorted(map(str, build(5).collect())) == sorted(map(str, build(1_000).collect()))


def test_metrics_from_summed_up_orders_equal_those_from_lines(spark):
    rows = [dict(USER_ID=f"u{i % 13}", ORDER_ID=None if i % 31 == 0 else f"o{i % 70}",
                 IS_LOYALTY=i % 4 == 0, CREATION_TIME_UTC=None if i % 17 == 0 else at(i * 7 % 250, i % 24),
                 ITEM_PRICE=None if i % 19 == 0 else f"{i}.25") for i in range(300)]
    df = items(spark, rows)
    orders = shared.customer_orders(df)
    for from_lines, from_orders in (
        (rfm.rfm(df), rfm.rfm_of(orders)),
        (churn.churn(df), churn.churn_of(orders)),
        (churn.churn(df, per="order"), churn.churn_of(orders, per="order")),
        (loyalty.loyalty(df), loyalty.loyalty_of(orders)),
    ):
        assert from_lines.schema == from_orders.schema
        assert sorted(map(str, from_lines.collect())) == sorted(map(str, from_orders.collect()))


def test_loyalty_flags_split_a_customer(spark):
    df = items(spark, [dict(IS_LOYALTY=True), dict(ORDER_ID="o2"), dict(ORDER_ID="o2")])
    got = {r["LOYALTY_STATUS"]: r for r in loyalty.loyalty(df).collect()}
    assert got["LOYALTY_MEMBER"]["TOTAL_ORDERS"] == 1
    assert got["NON_LOYALTY_MEMBER"]["AVG_ORDER_VALUE"] == 20.0


def test_active_days(spark):
    df = items(spark, [dict(CREATION_TIME_UTC=at(0, 1)), dict(CREATION_TIME_UTC=at(0, 2), ORDER_ID="o2")])
    assert locations.location_metrics(df).first()["ACTIVE_DAYS"] == 2
    by_day = locations.location_metrics(df, day_grain=True).first()
    assert by_day["ACTIVE_DAYS"] == 1 and by_day["ORDERS_PER_WEEK"] == pytest.approx(14)
    empty = locations.location_metrics(items(spark, [dict(CREATION_TIME_UTC=None)])).first()
    assert empty["ORDERS_PER_DAY"] is None


def test_retention(spark):
    df = items(spark, [dict(), dict(ORDER_ID="o2"), dict(USER_ID="u2"), dict(USER_ID="u2")])
    row = locations.location_retention(df).first()
    assert (row["CUSTOMERS"], row["RETURNING"], row["CUSTOMER_RETENTION_RATE"]) == (2, 1, 50.0)


def test_pricing(spark):
    df = items(spark, [dict(), dict(), dict(ORDER_ID="o2"), dict(ORDER_ID="o3", ITEM_PRICE="1.00")])
    extra = options(spark, [dict(OPTION_PRICE="-3.00", OPTION_QUANTITY=2), dict(OPTION_PRICE="5.00"),
                            dict(ORDER_ID="gone", OPTION_PRICE="-9.00")])
    got = {r["DISCOUNT_STATUS"]: r for r in pricing.pricing(df, extra).collect()}
    cut, full = got["DISCOUNTED_ORDER"], got["NON_DISCOUNTED_ORDER"]
    assert (cut["TOTAL_ORDERS"], cut["DISCOUNT_AMOUNT"], cut["NET_REVENUE"]) == (1, 3, 17)
    assert (full["TOTAL_ORDERS"], full["NET_REVENUE"]) == (2, 11)
    assert full["AVG_ORDER_VALUE"] == Decimal("5.50")
    assert cut["REVENUE_PERCENTAGE"] + full["REVENUE_PERCENTAGE"] == 100
    by_quantity = pricing.order_discounts(extra, use_quantity=True).where("ORDER_ID = 'o1'").first()
    assert by_quantity["DISCOUNT_AMOUNT"] == 6


def test_pricing_by_category_adds_up(spark):
    df = items(spark, [dict(), dict(ITEM_CATEGORY="drink"), dict(ORDER_ID="o2")])
    extra = options(spark, [dict(OPTION_PRICE="-3.00")])
    got = {(r["ITEM_CATEGORY"], r["DISCOUNT_STATUS"]): r["NET_REVENUE"]
           for r in pricing.pricing_by(df, extra, ["ITEM_CATEGORY"]).collect()}
    assert got == {("food", "DISCOUNTED_ORDER"): 7, ("drink", "DISCOUNTED_ORDER"): 10,
                   ("food", "NON_DISCOUNTED_ORDER"): 10}


def test_calendar_day_spelled_twice_joins_once(spark):
    days = spark.createDataFrame(
        [(dt.date(2023, 6, 30), False, True), (dt.date(2023, 6, 30), False, False), (None, True, True)],
        "date_key date, is_weekend boolean, is_holiday boolean")
    rows = sales.sales_by_calendar(items(spark, [dict(), dict(CREATION_TIME_UTC=None)]), days).collect()
    assert {(r["is_weekend"], r["is_holiday"], r["ITEMS_SOLD"]) for r in rows} == {
        (False, False, 1), (None, None, 1)}


def test_reference_time_is_the_last_line_with_a_customer(spark):
    df = items(spark, [dict(), dict(USER_ID=None, CREATION_TIME_UTC=at(-5))])
    row = churn.last_order(df).first()
    assert row["DAYS_SINCE_LAST_ORDER"] == 0 and str(row["LAST_ORDER_DATE"]) == T0
