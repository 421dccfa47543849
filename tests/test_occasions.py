"""Runs of days, interval joins and rolling sums against plain searches."""

import random
from datetime import date, timedelta

import pytest

from comanda.operators.intervals import overlap_join, runs_of_days
from comanda.operators.rolling import rolling_sum

D0 = date(2023, 1, 1)


def day(n):
    return None if n is None else D0 + timedelta(n)


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_runs_of_days(spark, span):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(60)])) for _ in range(120)]
    df = spark.createDataFrame([(k, day(n)) for k, n in rows], "k string, d date")
    found = {(r.k, r.FIRST_DAY, r.LAST_DAY, r.DAYS) for r in runs_of_days(df, "d", ["k"], span).collect()}
    wanted = set()
    for key in ("a", "b", None):
        days = {n for k, n in rows if k == key and n is not None}
        for first in sorted(n for n in days if n - 1 not in days):
            last = next(n for n in range(first, 62) if n + 1 not in days)
            wanted.add((key, day(first), day(last), last - first + 1))
    assert found == wanted
    assert runs_of_days(df.limit(0), "d").count() == 0


@pytest.mark.parametrize("bucket", [86_400, 10 * 86_400, 10**9])
@pytest.mark.parametrize("points", [False, True])
def test_overlap_join(spark, bucket, points):
    rng = random.Random(8)

    def spans(count):
        for n in range(count):
            first = rng.choice([None, *range(80)] if n % 9 == 0 else range(80))
            yield n, rng.choice(["a", "b", None]), first, None if first is None else first + rng.randint(-2, 25)

    left, right = list(spans(60)), list(spans(40))
    if points:
        left = [(n, k, a, a) for n, k, a, _ in left]
    a = spark.createDataFrame([(n, k, day(x), day(y)) for n, k, x, y in left], "n int, k string, x date, y date")
    b = spark.createDataFrame([(n, k, day(x), day(y)) for n, k, x, y in right], "m int, l string, u date, v date")
    for keys, spread in ([], []), ([("k", "l")], []), ([], ["n"]), ([("k", "l")], ["n"]):
        joined = overlap_join(a, b, ("x", "x") if points else ("x", "y"), ("u", "v"), keys, bucket, spread)
        found = sorted((r.n, r.m) for r in joined.collect())
        wanted = sorted(
            (n, m) for n, k, x, y in left for m, other, u, v in right
            if None not in (x, y, u, v) and x <= y and u <= v and x <= v and u <= y
            and (not keys or (k is not None and k == other))
        )
        assert found == wanted
    assert "NestedLoop" not in joined._jdf.queryExecution().toString()
    assert "Cartesian" not in joined._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(a, a, ("x", "y"), ("x", "y"))


@pytest.mark.parametrize("span", [1, 13, 365])
@pytest.mark.parametrize("days", [1, 7, 40])
def test_rolling_sum(spark, span, days):
    rng = random.Random(2)
    rows = [("hot" if n % 3 else rng.choice(["a", None]), rng.choice([None, *range(-20, 80)]),
             rng.choice([None, 1, 2, 5])) for n in range(200)]
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in rows], "k string, d date, v bigint")
    found = {(r.k, r.d): r.s for r in rolling_sum(df, "k", "d", "v", "s", days, span).collect()}
    wanted = {}
    for key, n, _ in rows:
        if n is not None:
            seen = [v for k, m, v in rows if k == key and m is not None and n - days < m <= n and v is not None]
            wanted[key, day(n)] = sum(seen) if seen else None
    assert found == wanted
    with pytest.raises(ValueError):
        rolling_sum(df, "k", "d", "v", "s", 0)


def test_a_hot_key_is_dealt_out(spark):
    """Groups of one key are its spans of time: no window runs over a whole key."""
    df = spark.createDataFrame([("hot", day(n), n) for n in range(1000)], "k string, d date, v bigint")
    plan = rolling_sum(df, "k", "d", "v", "s", 90, 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_span" in plan.split("Window")[1]
