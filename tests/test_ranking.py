"""The bucketed ranks against Spark's window functions."""

import random
import re
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from comanda.operators.ranking import (
    _value_counts,
    exact_quantiles,
    global_dense_rank,
    global_percent_rank,
    value_positions,
)
from comanda.plans.rfm import METRICS, _score, with_scores
from comanda.staging import Staged


def values(kind, n=600):
    pick = random.Random(7)
    if kind == "spread":
        return [pick.random() for _ in range(n)]
    if kind == "ties":  # one value holds a third of the rows
        return [1.0 if i % 3 == 0 else float(pick.randint(0, 20)) for i in range(n)]
    if kind == "nulls":
        return [None if i % 4 == 0 else pick.random() for i in range(n)]
    if kind == "one value":
        return [5.0] * n
    if kind == "all null":
        return [None] * n
    return {"single": [3.0], "empty": []}[kind]


KINDS = ["spread", "ties", "nulls", "one value", "all null", "single", "empty"]


def stored(spark, kind):
    return Staged.stored(
        spark.createDataFrame(list(enumerate(values(kind))), "id int, v double").repartition(4)
    )


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("rows_per_bucket", [50, 10_000])
def test_ranks_match_the_window_functions(spark, kind, rows_per_bucket):
    source = stored(spark, kind)
    up = Window.orderBy(F.asc_nulls_first("v"))
    down = Window.orderBy(F.desc_nulls_last("v"))
    expected = source.df.select(
        "id", F.percent_rank().over(up).alias("pr"), F.dense_rank().over(down).alias("dr")
    )
    pr = global_percent_rank(source, "v", "pr", rows_per_bucket).select("id", "pr")
    dr = global_dense_rank(source, "v", "dr", rows_per_bucket).select("id", "dr")
    assert sorted(pr.collect()) == sorted(expected.select("id", "pr").collect())
    assert sorted(dr.collect()) == sorted(expected.select("id", "dr").collect())


def test_small_buckets_share_tasks_and_files(spark):
    source = Staged.stored(spark.range(3_000).selectExpr("id", "if(id % 7 = 0, null, id % 1000) AS v"))
    counts = _value_counts(source, "v", (), 5)
    assert len(counts.inputFiles()) == 1
    sizes = [r["count"] for r in counts.groupBy("_bucket").count().collect()]
    assert len(sizes) == 201 and max(sizes) == 5
    found = {r["v"]: (r["ROWS_BEFORE"], r["VALUES_BEFORE"]) for r in value_positions(source, "v", rows_per_bucket=5).collect()}
    rows = sorted(-1 if i % 7 == 0 else i % 1000 for i in range(3_000))
    distinct = sorted(set(rows))
    assert found == {None if v == -1 else v: (rows.index(v), n) for n, v in enumerate(distinct)}


def scores_by_rank(customers):
    """The scores straight from Spark's percent rank."""
    ranks = [f"percent_rank() OVER (ORDER BY {m} ASC NULLS FIRST) AS _{m}" for m in METRICS]
    scores = [_score(m, f"_{m}", lambda q: f"{q}D") for m in METRICS]
    return customers.selectExpr("*", *ranks).selectExpr(*customers.columns, *scores)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_inputs_never_meet_in_one_partition(spark):
    source = Staged(spark.range(100_000).withColumnRenamed("id", "v"), 10_000_000)
    plan = plan_of(value_positions(source, "v"))
    # Only the bucket totals may meet.
    assert len(set(re.findall(r"SinglePartition.*plan_id=(\d+)", plan))) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_window_holds_the_values_of_a_group(spark):
    """Windows by group alone run over bucket totals (an aggregate by group and bucket), never over values."""
    df = spark.range(1_000).selectExpr("id % 3 AS g", "cast(id AS double) AS v")
    plan = plan_of(exact_quantiles(Staged(df, 10_000_000), "v", ["g"], {"mid": 0.5}))
    windows = re.findall(r"Window \[.*\], \[([^\[\]]*)\], \[([^\[\]]*)\]", plan)
    over_values = [keys for keys, order in windows if order.startswith("v#")]
    assert over_values and all("_bucket#" in keys for keys in over_values)
    assert any(order.startswith("_bucket#") for _, order in windows)


@pytest.mark.parametrize("rows_per_bucket", [40, 10_000])
def test_positions_per_group(spark, rows_per_bucket):
    rows = [("a" if i % 3 else None, i % 17) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = value_positions(Staged(df, 500), "v", ["g"], rows_per_bucket=rows_per_bucket).collect()
    for r in got:
        group = [v for g, v in rows if g == r["g"]]
        assert r["COPIES"] == group.count(r["v"])
        assert r["ROWS_BEFORE"] == sum(v < r["v"] for v in group)
        assert r["VALUES_BEFORE"] == len({v for v in group if v < r["v"]})
        assert r["GROUP_ROWS"] == len(group)
    assert len(got) == len(set(rows))


@pytest.mark.parametrize("rows_per_bucket", [30, 10_000])
def test_quantiles_interpolate(spark, rows_per_bucket):
    pick = random.Random(3)
    rows = [(g, None if pick.random() < 0.2 else round(pick.random() * 10, 1))
            for g in ("x", "y") for _ in range(201)] + [("none", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "hi": 1.0}
    got = {r["g"]: r for r in exact_quantiles(
        Staged(df, len(rows)), "v", ["g"], points, rows_per_bucket).collect()}
    for g in ("x", "y"):
        known = sorted(v for k, v in rows if k == g and v is not None)
        q1, mid, q3 = statistics.quantiles(known, n=4, method="inclusive")
        assert [got[g][p] for p in points] == pytest.approx([known[0], q1, mid, q3, known[-1]])
    assert [got["none"][p] for p in points] == [None] * 5
    assert [got["one"][p] for p in points] == [4.0] * 5


@pytest.mark.parametrize("n", [1, 2, 6, 11, 21, 500])
@pytest.mark.parametrize("rows_per_bucket", [5, 100])
def test_scores_by_cut_values_equal_scores_by_rank(spark, n, rows_per_bucket):
    pick = random.Random(n)
    rows = [(i, None if pick.random() < 0.1 else pick.randint(0, 30), 1 if i % 3 else i,
             None if pick.random() < 0.1 else f"{pick.randint(0, 9999) / 100:.2f}")
            for i in range(n)]
    df = spark.createDataFrame(rows, "id int, RECENCY int, FREQUENCY bigint, m string").selectExpr(
        "id", "RECENCY", "FREQUENCY", "cast(m AS decimal(31,2)) AS MONETARY")
    by_cuts = with_scores(Staged(df, n), rows_per_bucket).drop("RFM_SCORE")
    assert sorted(map(str, by_cuts.collect())) == sorted(map(str, scores_by_rank(df).collect()))


def test_scores_on_the_limits(spark):
    """Six customers have percent ranks 0, .2, .4, .6, .8 and 1; each limit belongs to the better score."""
    df = spark.createDataFrame([(i, i, i + 1) for i in range(6)], "id int, RECENCY int, FREQUENCY bigint")
    df = df.selectExpr("*", "cast(FREQUENCY AS decimal(31,2)) AS MONETARY")
    rows = with_scores(Staged.stored(df)).orderBy("id").collect()
    assert [r["R_SCORE"] for r in rows] == [5, 5, 4, 3, 2, 1]
    assert [r["F_SCORE"] for r in rows] == [1, 2, 3, 4, 5, 5]
    assert METRICS == ("RECENCY", "FREQUENCY", "MONETARY")
