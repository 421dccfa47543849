"""Quantiles from merged sketches against sorted values."""

import random

import pytest

from comanda.operators import quantiles as q

POINTS = {"LOW": 0.0, "Q1": 0.25, "MEDIAN": 0.5, "P99": 0.99, "HIGH": 1.0}


def near(values, found, point, slack):
    """Whether a value's rank, of all equal to it any, lies near the point."""
    below, upto = sum(v < found for v in values) / len(values), sum(v <= found for v in values) / len(values)
    return below - slack <= point <= upto + slack


def test_merged_sketches(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", None]), n % 50, rng.choice([7.0, rng.gauss(0, 10), None])) for n in range(20_000)]
    df = spark.createDataFrame(rows, "g string, d int, v double")
    daily = q.quantile_states(df, "v", ["g", "d"])
    merged = q.merged_states(q.merged_states(daily, ["g", "d"]), ["g"])
    for r in q.quantiles(merged, POINTS, ["g"]).collect():
        values = [v for g, _, v in rows if g == r.g and v is not None]
        assert r[q.ROWS] == len(values) and (r.LOW, r.HIGH) == (min(values), max(values))
        assert all(near(values, r[name], p, 2 * q.rank_error()) for name, p in POINTS.items())
    total = q.quantiles(q.merged_states(daily), POINTS).collect()
    assert [r[q.ROWS] for r in total] == [sum(v is not None for _, _, v in rows)]


def test_small_groups_are_exact_and_empty_ones_have_no_row(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", None), ("c", float("nan"))], "g string, v double")
    states = q.quantile_states(df, "v", ["g"])
    assert [tuple(r) for r in q.quantiles(states, {"M": 0.5}, ["g"]).collect()] == [("a", 3, 2.0)]
    assert q.merged_states(states.limit(0)).count() == 0
    assert q.quantile_states(df.limit(0), "v", ["g"]).count() == 0
    with pytest.raises(ValueError):
        q.quantiles(states, {"M": 1.5})


def test_error_bound():
    assert 0.0034 < q.rank_error() < 0.0036 and 0.0130 < q.rank_error(200) < 0.0136
