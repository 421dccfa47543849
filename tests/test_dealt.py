"""Gold datasets from lines that are dealt out once and stored, not shuffled."""

import pytest
from pyspark.sql import functions as F

from comanda.plans import churn, clv, locations, loyalty, pipeline, rfm, sales, shared
from comanda.schemas import GOLD
from comanda.sources.lake import extract_tables, read_layer, write_layer
from comanda.staging import SPLIT, SPLIT_BYTES, small_splits, stage, staged_by, staging_scope
from tests.data import items, options


def lines(spark, busy=False):
    rows = [
        dict(LINEITEM_ID=None if n == 11 else f"l{n}", ORDER_ID=None if n % 41 == 0 else f"o{n // 3}",
             RESTAURANT_ID=None if n % 503 == 7 else "r0" if busy and n % 2 else f"r{n % 450}",
             ITEM_CATEGORY=None if n % 37 == 0 else f"c{n % 3}", ITEM_PRICE=None if n % 29 == 0 else f"{n % 7}.25",
             IS_LOYALTY=None if n % 13 == 0 else n % 4 == 1, ITEM_QUANTITY=1 + n % 5,
             USER_ID=None if n % 10 == 0 else "" if n % 11 == 0 else f"u{n // 9}", PRINTED_CARD_NUMBER=None if n % 4 else f"C{n % 50}",
             CREATION_TIME_UTC=None if n % 19 == 0 else f"2023-0{1 + n % 6}-0{1 + n % 5} {n % 24:02}:00:00")
        for n in range(1_800)
    ]
    return items(spark, rows)


def extras(spark):
    rows = [dict(ORDER_ID=None if n % 41 == 0 else f"o{n // 3}", LINEITEM_ID=None if n % 31 == 11 else f"l{n}",
                 OPTION_PRICE=None if n % 23 == 0 else f"{n % 5 - 1}.50", OPTION_QUANTITY=n % 3) for n in range(1_800)]
    return options(spark, rows + rows[:200])


@pytest.fixture()
def unbroadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_dealt_lines_of_restaurants_are_not_shuffled(spark):
    plain = lines(spark)
    with staging_scope(spark, "t"), staged_by(plain.select(*pipeline.RESTAURANT_COLUMNS), "rest", ["RESTAURANT_ID"]) as dealt:
        trends = sales.sales_trends(dealt, dealt=True)
        assert "Exchange" not in plan_of(trends)
        assert rows_of(trends) == rows_of(sales.sales_trends(plain))
        found = locations.location_metrics(dealt, dealt=True)
        assert "ORDER_ID" not in "".join(l for l in plan_of(found).splitlines() if "Exchange" in l)
        assert rows_of(found) == rows_of(locations.location_metrics(plain))


def test_dealt_lines_and_options_meet_without_a_shuffle(spark, unbroadcast):
    plain, known = lines(spark), extras(spark)
    with (
        staging_scope(spark, "t"),
        staged_by(clv.value_lines(plain), "lines", clv.KEYS) as dealt,
        staged_by(known.select(*clv.OPTION_COLUMNS), "options", clv.KEYS) as dealt_options,
    ):
        totals = clv.totals_of(dealt, dealt_options)
        exchanges = [l for l in plan_of(totals).splitlines() if "Exchange" in l]
        assert len(exchanges) == 1 and "hashpartitioning(CUSTOMER_ID" in exchanges[0]
        assert rows_of(totals) == rows_of(clv.clv_totals(plain, known))


@pytest.mark.parametrize("busy", [False, True])
def test_gold_of_all_metrics_is_that_of_each(spark, tmp_path, busy):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_layer(lines(spark, busy), silver, "order_items")
    write_layer(extras(spark), silver, "order_item_options")
    before, tables = spark.conf.get(SPLIT_BYTES), spark.catalog.listTables()
    with staging_scope(spark, "t"):
        pipeline.build_gold(spark, silver, gold)
    assert spark.conf.get(SPLIT_BYTES) == before and spark.catalog.listTables() == tables
    stored = read_layer(spark, silver, "order_items"), read_layer(spark, silver, "order_item_options")
    for name, metric in pipeline.METRICS.items():
        assert rows_of(read_layer(spark, gold, name, GOLD[name])) == rows_of(metric(*stored)), name


def test_a_table_that_fails_leaves_the_catalog(spark):
    with pytest.raises(ZeroDivisionError), staging_scope(spark, "t"), staged_by(spark.range(3), "gone", ["id"]) as found:
        name = found.inputFiles()[0].split("/")[-2].rsplit("-", 1)[0]
        assert name == "gone" and any(t.name.startswith("gone_") for t in spark.catalog.listTables())
        1 / 0
    assert not any(t.name.startswith("gone_") for t in spark.catalog.listTables())


def test_small_splits_keep_a_smaller_limit(spark):
    before = spark.conf.get(SPLIT_BYTES)
    for given, wanted in (("1m", 2**20), ("128MB", SPLIT)):
        spark.conf.set(SPLIT_BYTES, given)
        with small_splits(spark):
            assert int(spark.conf.get(SPLIT_BYTES)) == wanted
        assert spark.conf.get(SPLIT_BYTES) == given
    spark.conf.set(SPLIT_BYTES, before)


def test_layers_write_pages_of_the_second_version(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    ids = spark.range(0, 40_000, 1, 1).select(F.concat(F.lit("a-long-prefix-"), F.col("id") + 1_000_000).alias("t"))
    write_layer(ids, str(tmp_path), "ids")
    found = pq.ParquetFile(glob.glob(f"{tmp_path}/ids/*.parquet")[0]).metadata.row_group(0).column(0)
    assert "DELTA_BYTE_ARRAY" in found.encodings and found.compression == "ZSTD"


def test_totals_of_customers_give_segments_churn_and_loyalty_without_another_shuffle_of_orders(spark):
    plain = lines(spark)
    totals = shared.customer_totals(plain)
    main = plan_of(totals).split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") == 2
    totals = stage(totals, "customers").df
    for of_totals in (churn.churn_of_totals, loyalty.loyalty_of_totals):
        assert "Exchange hashpartitioning" not in plan_of(of_totals(totals))
    assert rows_of(rfm.rfm_of_totals(totals)) == rows_of(rfm.rfm(plain))
    assert rows_of(churn.churn_of_totals(totals)) == rows_of(churn.churn(plain))
    assert rows_of(loyalty.loyalty_of_totals(totals)) == rows_of(loyalty.loyalty(plain))


def test_totals_take_a_reference_date_and_blank_ids_for_null(spark):
    plain = lines(spark)
    day = spark.sql("SELECT timestamp '2023-09-10 00:00:00' AS REFERENCE_DATE")
    totals = stage(shared.customer_totals(plain, day, blank_as_null=True), "customers").df
    wanted = churn.churn(plain, day, blank_as_null=True)
    assert rows_of(churn.churn_of_totals(totals, day)) == rows_of(wanted)
    assert wanted.where("PREVIOUS_SPEND > 0").count() > 0


def test_totals_without_a_known_price_are_null(spark):
    rows = [dict(ORDER_ID=None, ITEM_PRICE=None, IS_LOYALTY=None, CREATION_TIME_UTC=None), dict(USER_ID="u2", ITEM_PRICE=None)]
    plain = items(spark, rows)
    totals = stage(shared.customer_totals(plain), "customers").df
    assert rows_of(rfm.rfm_of_totals(totals)) == rows_of(rfm.rfm(plain))
    assert rows_of(churn.churn_of_totals(totals)) == rows_of(churn.churn(plain))
    assert rows_of(loyalty.loyalty_of_totals(totals)) == rows_of(loyalty.loyalty(plain))


def test_extract_sorts_the_rows_of_a_task(spark, tmp_path):
    given = extras(spark).coalesce(1)
    counts = extract_tables(lambda _: given, ["dbo.options", "dbo.plain"], str(tmp_path), {"options": ("ORDER_ID", "LINEITEM_ID")})
    assert counts == {"options": 2_000, "plain": 2_000}
    stored = read_layer(spark, str(tmp_path), "options")
    ids = [(r.ORDER_ID or "", r.LINEITEM_ID or "") for r in stored.collect()]
    assert ids == sorted(ids) and rows_of(stored) == rows_of(given)
