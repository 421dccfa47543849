"""As-of joins against a plain search."""

import random

import pytest

from comanda.operators.asof import asof_join


def cases():
    rng = random.Random(3)
    day = lambda: f"2023-{rng.randint(1, 12):02}-{rng.randint(1, 28):02} {rng.randint(0, 3):02}:00:00"
    key = lambda: rng.choice(["big", "big", "a", "b", "c", None])
    rows = [(n, key(), None if n % 19 == 0 else day()) for n in range(300)]
    values = [(key(), None if n % 23 == 0 else day(), None if n % 7 == 0 else n) for n in range(150)]
    return rows + [(n, k, t) for n, (k, t, _) in enumerate(values[:40], 1000)], values


@pytest.mark.parametrize("span", [1, 40 * 86_400, 10**9])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, span, strict):
    rows, values = cases()
    left = spark.createDataFrame(rows, "n int, k string, t string").selectExpr("n", "k", "cast(t as timestamp) t")
    right = spark.createDataFrame(values, "k string, t string, v int").selectExpr("k", "cast(t as timestamp) t", "v")
    found = {r.n: r.last for r in asof_join(left, right, "k", "t", "v", "last", span, strict).collect()}
    wanted = {}
    for n, k, t in rows:
        seen = [(vt, v is not None, v or 0, v) for vk, vt, v in values
                if k is not None and vk == k and t and vt and (vt < t or (vt == t and not strict))]
        wanted[n] = max(seen)[3] if seen else None
    assert found == wanted


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", None)], "n int, k string, t timestamp")
    none = left.limit(0).selectExpr("k", "t", "n as v")
    assert [tuple(r) for r in asof_join(left, none, "k", "t", "v", "last").collect()] == [(1, "a", None, None)]
    assert asof_join(left.limit(0), none, "k", "t", "v", "last").count() == 0
