"""Components of hubs, chains and giants, with and without adaptive execution."""

import random

import pytest

from comanda.llm.components import components


def reached(links):
    label = {n: n for link in links if None not in link for n in link}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            label[high] = low
    return {n: root(n) for n in label}


def star_and_chain():
    rng = random.Random(1)
    links = [(500, n) for n in range(1000, 4000)]  # a hub in the middle of its ids
    links += [(n, n + 1) for n in range(5000, 5060)]
    links += [(rng.randrange(6000, 6400), rng.randrange(6000, 6400)) for _ in range(150)]
    links += [(7, 7), (None, 3), (4, None), (3999, 5060)]
    rng.shuffle(links)
    return links


@pytest.fixture(params=["true", "false"])
def adaptive(spark, request):
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_components(spark, adaptive):
    links = star_and_chain()
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == reached(links)
    assert found.count() == len(reached(links))


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_hub_is_dealt_out(spark, monkeypatch):
    """The rows of a hub's edges meet their label in many tasks."""
    from comanda.llm import components as module
    from pyspark.sql import functions as F

    salted = []
    whole = module.join_heavy

    def watched(rows, others, keys, other_keys, spread, how, heavy):
        salted.append((keys[0], {r["_salts"] for r in heavy.collect()}))
        return whole(rows, others, keys, other_keys, spread, how, heavy=heavy)

    monkeypatch.setattr(module, "join_heavy", watched)
    links = spark.range(1, 3001).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    assert {r.component for r in module.components(links).collect()} == {0}
    # Half of the edges end at the hub, and the component holds all nodes: about 100 and 200 parts.
    assert ("b", {100}) in salted and ("component", {200}) in salted


def test_mixed_buckets_meet_in_squares_without_adaptive_execution(spark, monkeypatch):
    from pyspark.sql import functions as F

    from comanda.llm import near_dup
    from tests.llm.test_brute import as_docs, groups, near_texts

    monkeypatch.setattr(near_dup, "BLOCK", 4)
    monkeypatch.setattr(near_dup, "SIDE", 2)
    squares, compared = [], near_dup._compare_in_blocks

    def watched(loose, blocks, percent):
        squares.append(loose.select("key", "_down", "_across").distinct().groupBy("key").count().agg(F.max("count")).first()[0])
        return compared(loose, blocks, percent)

    monkeypatch.setattr(near_dup, "_compare_in_blocks", watched)
    texts = near_texts()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(as_docs(spark, texts), words=2).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert found == groups(dict(enumerate(texts)), 2)
    assert squares and max(squares) > 1


def test_heavy_buckets_come_from_their_counts(spark):
    from comanda.llm import near_dup

    sizes = [(1, 0, 1000), *[(key, 0, 2) for key in range(2, 502)]]
    heavy = near_dup._heavy_buckets(spark.createDataFrame(sizes, "key bigint, pivot bigint, n bigint"))
    assert [r["_salts"] for r in heavy.collect()] == [100]
    empty = spark.createDataFrame([], "key bigint, pivot bigint, n bigint")
    assert near_dup._heavy_buckets(empty).isEmpty()


def test_sketches_do_not_depend_on_the_lot():
    import numpy as np

    from comanda.llm.near_dup import sketches

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for size in (1, 700, 3, 2000, 50, 1, 900)]
    whole = sketches(sets, together=10**9)
    assert all((sketches(sets, together=n) == whole).all() for n in (1, 2, 704, 1000))
    assert all((sketches([s])[0] == row).all() for s, row in zip(sets, whole))
    assert sketches([]).shape[0] == 0
