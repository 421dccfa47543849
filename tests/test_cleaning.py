from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from comanda.operators import cleaning, profiling
from comanda.schemas import SILVER

RAW = """LINEITEM_ID string, ORDER_ID string, APP_NAME string, RESTAURANT_ID string, CURRENCY string,
    ITEM_CATEGORY string, ITEM_NAME string, CREATION_TIME_UTC string, ITEM_PRICE string,
    ITEM_QUANTITY string, IS_LOYALTY string, USER_ID string, PRINTED_CARD_NUMBER string"""


def raw(spark, *rows):
    plain = dict(l="l1", o="o1", t="2023-01-01 10:00:00", p="5.00", q="2", loyal="1", u="u1", c=None)
    values = []
    for row in rows:
        r = {**plain, **row}
        values.append((r["l"], r["o"], " app ", " r1 ", " USD", "food ", "dish", r["t"], r["p"],
                       r["q"], r["loyal"], r["u"], r["c"]))
    return spark.createDataFrame(values, RAW)


def test_bad_text_becomes_null_and_never_raises(spark):
    rows = cleaning.clean_order_items(
        raw(spark, dict(l="a", t="zz"), dict(l="b", p="abc"), dict(l="c", q="abc"),
            dict(l="d", loyal="True"), dict(l="e", p="123456789.00"), dict(l="f", p="1.005"))
    ).collect()
    got = {r["LINEITEM_ID"]: r for r in rows}
    assert got["a"]["CREATION_TIME_UTC"] is None
    assert got["b"]["ITEM_PRICE"] is None and got["e"]["ITEM_PRICE"] is None
    assert "c" not in got
    assert got["d"]["IS_LOYALTY"] is False and got["a"]["IS_LOYALTY"] is True
    assert got["f"]["ITEM_PRICE"] == Decimal("1.01")


def test_quantity_text_with_fraction_is_cut_off(spark):
    rows = cleaning.clean_order_items(
        raw(spark, dict(l="a", q="3.0"), dict(l="b", q="2.9"), dict(l="c", q="-1"),
            dict(l="d", q="0"), dict(l="e", q=None))
    ).collect()
    assert {r["LINEITEM_ID"]: r["ITEM_QUANTITY"] for r in rows} == {"a": 3, "b": 2}


def test_ids(spark):
    rows = cleaning.clean_order_items(
        raw(spark, dict(l="a", u=None, c=None), dict(l="b", u="  ", c="  "),
            dict(l="c", u=" u ", c=" 42 "))
    ).collect()
    got = {r["LINEITEM_ID"]: (r["USER_ID"], r["PRINTED_CARD_NUMBER"], r["USER_ID_STATUS"],
                              r["CARD_NUMBER_STATUS"]) for r in rows}
    assert got == {
        "a": (None, None, "MISSING_USER_ID", "MISSING_CARD_NUMBER"),
        "b": ("  ", "", "MISSING_USER_ID", "MISSING_CARD_NUMBER"),
        "c": (" u ", "42", "VALID_USER_ID", "VALID_CARD_NUMBER"),
    }


def test_dedupe_keeps_the_least_row_and_one_null_key(spark):
    df = raw(spark, dict(l=None, o="2"), dict(l=None, o="1"), dict(l="x", o="9", q=None),
             dict(l="x", o="9", q="1"))
    rows = cleaning.dedupe(df, ["LINEITEM_ID"]).collect()
    assert {(r["LINEITEM_ID"], r["ORDER_ID"], r["ITEM_QUANTITY"]) for r in rows} == {
        (None, "1", "2"), ("x", "9", None)
    }
    assert cleaning.dedupe(df, df.columns).count() == 4


def test_dedupe_goes_before_the_quantity_filter(spark):
    rows = cleaning.clean_order_items(raw(spark, dict(l="x", q="0"), dict(l="x", q="5"))).collect()
    assert rows == []


def test_dedupe_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    kept = cleaning.dedupe(df, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit"):]
    assert kept.where("k = 'hot'").first()["v"] == 0
    assert kept.count() == df.select("k").distinct().count()


def test_dedupe_sends_only_rows_of_repeated_keys_through_the_window(spark, monkeypatch):
    df = spark.range(5_000).selectExpr(
        "if(id % 1000 = 0, null, id % 4990) AS k", "cast(id % 3 AS double) AS v", "if(id % 2 = 0, null, id) AS w"
    )
    seen, window = [], cleaning.least_rows
    expected = sorted(map(str, window(df, ["k"]).collect()))
    monkeypatch.setattr(cleaning, "least_rows", lambda rows, keys: seen.append(rows.count()) or window(rows, keys))
    assert sorted(map(str, cleaning.dedupe(df, ["k"]).collect())) == expected
    assert len(seen) == 1 and 23 <= seen[0] < 50
    monkeypatch.setattr(cleaning, "SLOTS", 1)  # every slot is marked: all rows take the window
    assert sorted(map(str, cleaning.dedupe(df, ["k"]).collect())) == expected
    assert seen[-1] == 5_000


@pytest.mark.parametrize("slots", [cleaning.SLOTS, 1])
def test_only_rows_that_may_come_again_are_counted_whole(spark, monkeypatch, slots):
    monkeypatch.setattr(cleaning, "SLOTS", slots)
    df = spark.range(2_000).selectExpr("if(id % 500 = 0, null, id % 1990) AS k", "string(id % 1990 % 9) AS v", "id AS other")
    kept = cleaning.singleton_rows(df, ["k", "v"])
    plain = df.groupBy("k", "v").count().where("count = 1").drop("count")
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect())) and kept.columns == ["k", "v"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "xxhash64" in plan


def test_columns_that_the_schema_does_not_name_stay(spark):
    items = raw(spark, dict(l="a"), dict(l="b")).withColumn("NOTE", F.lit("kept"))
    once = cleaning.clean_order_items(items)
    assert once.columns[-1] == "NOTE" and {r["NOTE"] for r in once.collect()} == {"kept"}
    again = cleaning.clean_order_items(once.withColumn("IS_LOYALTY", F.col("IS_LOYALTY").cast("int")))
    assert sorted(once.collect()) == sorted(again.collect())


def test_silver_is_stable_under_a_second_pass(spark):
    once = cleaning.clean_order_items(raw(spark, dict(l="a"), dict(l="a"), dict(l="b", u=None)))
    again = cleaning.clean_order_items(
        once.withColumn("IS_LOYALTY", F.col("IS_LOYALTY").cast("int"))
    )
    assert sorted(once.collect()) == sorted(again.collect())


def test_every_copy_of_a_repeated_option_goes(spark):
    ddl = SILVER["order_item_options"].replace("decimal(10,2)", "string")
    df = spark.createDataFrame(
        [("o", "l", "g", "once", "1", 1), ("o", "l", "g", "twice", "1", 1),
         ("o", "l", "g ", " twice", "1.00", 1), ("o", "l", None, None, None, 1),
         ("o", "l", None, None, None, 1), ("o", "l", None, None, None, 1),
         ("o", None, "g", "n", "-1", 2)], ddl)
    rows = cleaning.clean_options(df).collect()
    assert {(r["LINEITEM_ID"], r["OPTION_NAME"], r["OPTION_PRICE"]) for r in rows} == {
        ("l", "once", Decimal("1.00")), (None, "n", Decimal("-1.00"))
    }


def test_two_spellings_of_a_day_both_stay(spark):
    df = spark.createDataFrame(
        [("2023-01-01", "2023", "1", "52", " Sunday", "true", "1", " New Year "),
         ("2023-1-1", "2023.0", "x", "52", "Sunday", "no", "maybe", None),
         ("2023-01-01", "2023", "1", "52", " Sunday", "true", "1", " New Year ")],
        "date_key string, year string, month string, week string, day_of_week string, "
        "is_weekend string, is_holiday string, holiday_name string")
    rows = cleaning.clean_date_dim(df).collect()
    assert len(rows) == 2 and len({r["date_key"] for r in rows}) == 1
    assert {(r["year"], r["month"], r["is_weekend"], r["is_holiday"], r["holiday_name"])
            for r in rows} == {(2023, 1, True, True, "New Year"), (2023, None, False, None, None)}


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a int, b string")
    assert [tuple(r) for r in profiling.duplicate_rows(df).collect()] == [(1, None, 2)]
    assert {tuple(r) for r in profiling.duplicate_keys(df, ["b"]).collect()} == {(None, 2), ("x", 2)}
    assert tuple(profiling.null_counts(df).first()) == (1, 2)
    assert {tuple(r) for r in profiling.null_summary(df).collect()} == {("a", 1), ("b", 2)}
    assert tuple(profiling.null_counts(df.limit(0)).first()) == (None, None)


def test_counted_hashes_of_keys_take_five_bytes(spark):
    rows = spark.range(500).selectExpr("cast(id % 450 AS string) AS K", "id AS V")
    plan = cleaning.dedupe(rows, ["K"])._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64(K" in plan and str(cleaning.HASHES) in plan
    kept = cleaning.dedupe(rows, ["K"]).collect()
    assert sorted(r.V for r in kept) == list(range(450))
