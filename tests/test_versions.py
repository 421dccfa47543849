"""Tables by versions: merges, failures half-way, and readers between writes."""

import os

import pytest
from pyspark.sql import functions as F

from comanda.sources import versions

SCHEMA = "k bigint, t string, n int"


def rows_of(spark, root, **more):
    return sorted((tuple(r) for r in versions.read_table(spark, root, "t", **more).collect()), key=str)


def data_files(root):
    return {
        (os.path.join(folder, name), os.path.getmtime(os.path.join(folder, name)))
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path)


def test_replacing_a_table(spark, root):
    first = spark.createDataFrame([(1, "a", 1), (2, None, 2)], SCHEMA)
    versions.replace_table(first, root, "t")
    before = versions.current(spark, root, "t")
    versions.replace_table(first.where("k = 1"), root, "t", partition_by=["n"])
    assert rows_of(spark, root) == [(1, "a", 1)]
    assert len(rows_of(spark, root, version=before)) == 2  # a reader of the old version goes on
    assert len(versions.drop_old(spark, root, "t")) == 1
    assert rows_of(spark, root) == [(1, "a", 1)]


def test_a_failed_write_leaves_the_old_version(spark, root):
    versions.replace_table(spark.range(5).select(F.col("id").alias("k")), root, "t", keys=["k"], buckets=4)
    before = versions.current(spark, root, "t")
    fails = spark.range(0, 5000, 1, 8).select(F.when(F.col("id") == 4999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(fails, root, "t", keys=["k"], buckets=4)
    with pytest.raises(Exception, match="lost"):
        versions.merge_table(fails, root, "t")
    assert versions.current(spark, root, "t") == before
    assert rows_of(spark, root) == [(n,) for n in range(5)]


def test_a_merge_equals_a_rebuild_and_leaves_other_files(spark, root):
    base = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("t"), F.lit(1).alias("n"))
    base = base.unionByName(spark.createDataFrame([(None, "old", 1)], SCHEMA))
    versions.replace_table(base, root, "t", keys=["k"], buckets=32)
    before = data_files(root)
    changes = spark.createDataFrame([(7, "new", 2), (7, "least", 2), (9000, "new", 2), (None, "new", 2)], SCHEMA)
    deleted = spark.createDataFrame([(11,), (12345,), (9000,)], "k bigint")
    touched = versions.merge_table(changes, root, "t", deleted)
    wanted = base.where("k is not null and k not in (7, 11)").unionByName(
        spark.createDataFrame([(7, "least", 2), (9000, "new", 2), (None, "new", 2)], SCHEMA)
    )
    assert rows_of(spark, root) == sorted((tuple(r) for r in wanted.collect()), key=str)
    assert 0 < len(touched) <= 5 and before <= data_files(root)
    pointer = versions.current(spark, root, "t")
    old = [f for b, f in pointer["folders"].items() if int(b) not in touched]
    assert len(old) >= 27 and len({f.split("/")[0] for f in old}) == 1


def test_empty_tables_and_changes(spark, root):
    none = spark.createDataFrame([], SCHEMA)
    versions.replace_table(none, root, "t", keys=["k"], buckets=4)
    assert rows_of(spark, root) == [] and versions.merge_table(none, root, "t") == []
    versions.merge_table(spark.createDataFrame([(1, "a", 1)], SCHEMA), root, "t")
    assert rows_of(spark, root) == [(1, "a", 1)]
    versions.merge_table(none, root, "t", spark.createDataFrame([(1,)], "k bigint"))
    assert rows_of(spark, root) == []


def test_refused(spark, root, monkeypatch):
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, root, "t")
    frame = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    versions.replace_table(frame, root, "t")
    with pytest.raises(ValueError):
        versions.merge_table(frame, root, "t")
    with pytest.raises(ValueError):
        versions.replace_table(frame, root, "t", partition_by=["n"], keys=["k"])
    stale = versions.current(spark, root, "t")
    versions.replace_table(frame, root, "t")
    with pytest.raises(versions.ChangedMeanwhile):
        versions._point(spark, root, "t", stale | {"version": "x"}, stale)
