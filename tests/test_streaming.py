"""The stream of sales: late and repeated lines, folds, failures."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from comanda.plans.sales import sales_daily
from comanda.streaming import sales as streamed
from tests.data import items


def lines(spark):
    days = ["2023-06-30 12:00:00", "2023-06-30 23:10:00", "2023-07-01 08:00:00", None]
    rows = [
        {"LINEITEM_ID": f"l{n}", "ORDER_ID": None if n == 7 else f"o{n // 3}", "CREATION_TIME_UTC": days[n % 4],
         "ITEM_PRICE": None if n == 5 else "2.50", "ITEM_QUANTITY": n % 3 + 1, "RESTAURANT_ID": f"r{n % 2}"}
        for n in range(24)
    ]
    return items(spark, rows)


def figures(df):
    return sorted((tuple(r) for r in df.drop("SALES_PERIOD").collect()), key=str)


@pytest.fixture()
def folders(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "streamed")


def land(df, landing):
    df.coalesce(1).write.mode("append").parquet(landing)


def test_late_and_repeated_lines(spark, folders):
    landing, root = folders
    all_lines = lines(spark)
    number = F.substring("LINEITEM_ID", 2, 9).cast("int")
    land(all_lines.where(F.to_date("CREATION_TIME_UTC") == "2023-07-01"), landing)
    streamed.ingest_sales(spark, landing, root)
    # A day before all that was seen, and half of the lines again.
    land(all_lines.where("to_date(CREATION_TIME_UTC) <> '2023-07-01' or CREATION_TIME_UTC is null"), landing)
    land(all_lines.where(number % 2 == 0), landing)
    streamed.ingest_sales(spark, landing, root, max_files=1)
    wanted = figures(sales_daily(all_lines))
    assert figures(streamed.streamed_sales(spark, root)) == wanted
    assert streamed.ingest_sales(spark, landing, root) == []  # nothing new
    last = streamed.fold(spark, root)
    assert figures(streamed.streamed_sales(spark, root)) == wanted
    assert streamed.fold(spark, root) == last  # again: no part counts twice
    assert max(streamed.drop_folded(spark, root)) == last and streamed.whole_batches(spark, root) == []
    assert figures(streamed.streamed_sales(spark, root)) == wanted
    land(all_lines.where("LINEITEM_ID = 'l3'").withColumn("LINEITEM_ID", F.lit("new")), landing)
    streamed.ingest_sales(spark, landing, root)
    total = streamed.streamed_sales(spark, root, []).first()
    assert total.ITEMS_SOLD == all_lines.agg(F.sum("ITEM_QUANTITY")).first()[0] + 1
    assert total.TOTAL_ORDERS == all_lines.agg(F.count_distinct("ORDER_ID")).first()[0]


def test_no_lines(spark, folders):
    landing, root = folders
    land(lines(spark).limit(0), landing)
    assert streamed.streamed_sales(spark, root).count() == 0
    assert streamed.fold(spark, root) == -1
    streamed.ingest_sales(spark, landing, root)
    streamed.fold(spark, root)
    assert streamed.streamed_sales(spark, root).count() == 0


def test_a_batch_that_fails_counts_once(spark, folders, monkeypatch):
    landing, root = folders
    all_lines = lines(spark)
    land(all_lines, landing)
    sums, calls = streamed.part_sums, []

    def broken(batch):
        calls.append(1)
        if len(calls) == 1:  # a part is written, then the batch fails
            sums(batch).write.parquet(f"{root}/parts/BATCH=0/torn")
            raise RuntimeError("lost")
        return sums(batch)

    monkeypatch.setattr(streamed, "part_sums", broken)
    with pytest.raises(Exception, match="lost"):
        streamed.ingest_sales(spark, landing, root)
    monkeypatch.undo()
    assert streamed.whole_batches(spark, root) == []
    streamed.ingest_sales(spark, landing, root)
    assert figures(streamed.streamed_sales(spark, root)) == figures(sales_daily(all_lines))


def test_state_lies_on_disk_and_the_session_keeps_its_store(spark, folders):
    landing, root = folders
    before = spark.conf.get(f"{streamed.STORES}.providerClass")
    land(lines(spark), landing)
    streamed.ingest_sales(spark, landing, root)
    assert spark.conf.get(f"{streamed.STORES}.providerClass") == before == streamed.IN_MEMORY
    assert spark.conf.get(f"{streamed.STORES}.rocksdb.boundedMemoryUsage", "unset") in ("unset", "false")
    states = list(Path(root, "checkpoint", "state").rglob("*.changelog")) + list(Path(root, "checkpoint", "state").rglob("*.zip"))
    assert states and not list(Path(root, "checkpoint", "state").rglob("*.delta"))


def test_a_stream_that_began_with_another_store_goes_on(spark, folders, monkeypatch):
    landing, root = folders
    all_lines = lines(spark)
    monkeypatch.setattr(streamed, "ON_DISK", {})
    land(all_lines.where("LINEITEM_ID < 'l2'"), landing)
    streamed.ingest_sales(spark, landing, root)
    monkeypatch.undo()
    land(all_lines, landing)
    streamed.ingest_sales(spark, landing, root)
    assert figures(streamed.streamed_sales(spark, root)) == figures(sales_daily(all_lines))
    assert list(Path(root, "checkpoint", "state").rglob("*.delta"))


def test_a_stream_reads_the_columns_of_its_sums_only(spark, folders, monkeypatch):
    landing, root = folders
    land(lines(spark), landing)
    seen, sums = [], streamed.part_sums
    monkeypatch.setattr(streamed, "part_sums", lambda batch: seen.append(batch.columns) or sums(batch))
    streamed.ingest_sales(spark, landing, root)
    assert set(seen[0]) == {*streamed.LINE_COLUMNS, streamed.ARRIVED}
    assert set(streamed.arriving_lines(spark, landing).columns) == {*lines(spark).columns, streamed.ARRIVED}


@pytest.mark.parametrize("busy", [False, True])
def test_parts_are_shuffled_once_unless_a_group_is_busy(spark, folders, busy):
    landing, root = folders
    rows = [dict(LINEITEM_ID=f"l{n}", ORDER_ID=None if n % 31 == 0 else f"o{n // 2}", RESTAURANT_ID=None if n % 401 == 5 else
                 "r0" if busy and n % 3 == 0 else f"r{n % 400}", ITEM_CATEGORY=f"c{n % 3}") for n in range(1_600)]
    all_lines = items(spark, rows)
    land(all_lines, landing)
    streamed.ingest_sales(spark, landing, root)
    found = streamed.streamed_sales(spark, root)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (2 if busy else 1)
    assert figures(found) == figures(sales_daily(all_lines))
    total = streamed.streamed_sales(spark, root, []).first()
    assert total.TOTAL_ORDERS == all_lines.agg(F.count_distinct("ORDER_ID")).first()[0]
