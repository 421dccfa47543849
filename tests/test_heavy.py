"""Salted joins of heavy keys: equal to plain joins, and spread over the tasks without adaptive execution."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from comanda.operators.heavy import heavy_keys, join_heavy

ROWS = 30_000


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in (n.replace("__", ".") for n in values)}
    for key, value in values.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def lines(spark):
    """A third of the lines in one order, a tenth without one."""
    order = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 10 != 1, F.concat(F.lit("o"), F.col("id") % 4000))
    return spark.range(ROWS).select(F.col("id").alias("line"), order.alias("order"))


@pytest.fixture(scope="module")
def orders(lines):
    return lines.groupBy(F.col("order").alias("of")).agg(F.count(F.lit(1)).alias("n")).where("coalesce(n, 0) <> 7")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equal_to_a_plain_join(lines, orders, how):
    met = F.col("order").eqNullSafe(F.col("of"))
    plain = lines.join(orders, met, how)
    found = join_heavy(lines, orders, ["order"], ["of"], ["line"], how, parts=20)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_heavy_keys(lines):
    found = {r["_key"]: r["_salts"] for r in heavy_keys(lines, ["order"], 20).collect()}
    wanted = lines.groupBy("order").count().where(f"count > {ROWS} / 20").select(F.xxhash64("order"), "count").collect()
    assert set(found) == {r[0] for r in wanted} and len(found) == 2
    assert all(found[r[0]] >= r[1] * 20 / ROWS for r in wanted)


def test_no_task_above_twice_the_median(spark, lines, orders):
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        found = join_heavy(lines, orders, ["order"], ["of"], ["line"])
        tasks = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        plain = lines.join(orders, F.col("order").eqNullSafe(F.col("of")))
        hot = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
    assert hot[-1] > 2 * hot[len(hot) // 2]


def test_empty_sides_and_refused_joins(spark, lines, orders):
    assert join_heavy(lines.limit(0), orders, ["order"], ["of"], ["line"]).count() == 0
    assert join_heavy(lines, orders.limit(0), ["order"], ["of"], ["line"], "left").count() == ROWS
    with pytest.raises(ValueError):
        join_heavy(lines, orders, ["order"], ["of"], ["line"], "full")
    with pytest.raises(ValueError):
        heavy_keys(lines, ["order"], 1)
