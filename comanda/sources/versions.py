"""Tables that are replaced whole and merged by buckets, with readers never between two versions.

A table folder holds data folders and a pointer file. A write makes new data folders, and only when all of them are
there does a new pointer file take the old one's place by a rename. A write that fails half-way
leaves the pointer, so readers keep the version before. A bucketed table points to one folder per
bucket of its key's hash: a merge rewrites the buckets that the changes touch and points to the others as they are.

The pointer names at most one folder per bucket, so its size does not grow with the rows. Folders that no pointer
names any more stay until ``drop_old``, as readers may still be scanning them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators.cleaning import dedupe
from comanda.schemas import schema_of
from comanda.sources.lake import CODEC, table_path

POINTER, BUCKET = "_current.json", "_bucket"
BUCKETS = 256


class ChangedMeanwhile(RuntimeError):
    """Another writer replaced the table after this one read it."""


def _file_context(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def current(spark: SparkSession, root: str, table: str) -> dict | None:
    """What the pointer says: ``version``, ``folders`` and, of a bucketed table, ``keys`` and ``buckets``."""
    folder = table_path(root, table)
    context, path = _file_context(spark, folder), _path(spark, f"{folder}/{POINTER}")
    if not context.util().exists(path):
        return None
    stream = context.open(path)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def _point(spark: SparkSession, root: str, table: str, pointer: dict, before: dict | None) -> None:
    """The new pointer takes the place of the old one, unless that is no longer ``before``."""
    folder = table_path(root, table)
    context = _file_context(spark, folder)
    made, final = _path(spark, f"{folder}/_pointer-{uuid.uuid4().hex}"), _path(spark, f"{folder}/{POINTER}")
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(made, False)
    try:
        out.write(bytearray(json.dumps(pointer).encode()))
    finally:
        out.close()
    if (current(spark, root, table) or {}).get("version") != (before or {}).get("version"):
        system.delete(made, False)
        raise ChangedMeanwhile(f"{table} has another version than the one this write began from")
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(made, final, how)


def replace_table(
    df: DataFrame, root: str, table: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (), buckets: int = BUCKETS
) -> None:
    """Replace a table. With ``keys`` it is stored by buckets and can be merged; else ``partition_by`` may order it."""
    spark, before = df.sparkSession, current(df.sparkSession, root, table)
    name, folder = f"data-{uuid.uuid4().hex}", table_path(root, table)
    pointer: dict = {"version": uuid.uuid4().hex, "folders": [name], "schema": df.schema.json()}
    if keys:
        if partition_by:
            raise ValueError("a table is stored by buckets or by columns, not both")
        placed = _bucketed(df, keys, buckets)
        placed.write.partitionBy(BUCKET).parquet(f"{folder}/{name}", compression=CODEC)
        held = _written(spark, f"{folder}/{name}")
        pointer |= {"keys": list(keys), "buckets": buckets, "folders": {str(b): f"{name}/{BUCKET}={b}" for b in held}}
    else:
        df.write.parquet(f"{folder}/{name}", partitionBy=list(partition_by) or None, compression=CODEC)
    _point(spark, root, table, pointer, before)


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows dealt out by bucket and a hash of the row, so that a bucket may be written by several tasks."""
    placed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    return placed.repartition(BUCKET)


def _written(spark: SparkSession, folder: str) -> list[int]:
    """Buckets that a write has made; at most as many as the table has."""
    found = _file_context(spark, folder).util().listStatus(_path(spark, folder))
    names = [status.getPath().getName() for status in found]
    return sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}="))


def read_table(spark: SparkSession, root: str, table: str, ddl: str | None = None, version: dict | None = None) -> DataFrame:
    """The current version, or one that ``current`` gave before."""
    found = version or current(spark, root, table)
    if found is None:
        raise FileNotFoundError(f"no version of {table} under {root}")
    folder = table_path(root, table)
    declared = schema_of(ddl) if ddl else schema_of_json(found["schema"])
    folders = found["folders"]
    names = list(folders.values()) if isinstance(folders, dict) else folders
    if not names:
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).parquet(*[f"{folder}/{name}" for name in names]).select(declared.fieldNames())


def schema_of_json(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def merge_table(changes: DataFrame, root: str, table: str, deleted: DataFrame | None = None) -> list[int]:
    """Put changed rows in the place of those with their keys, add new ones, and take out those of ``deleted`` keys.

    Of several changes with one key the least row stays, as in ``dedupe``; NULL is one key. A key that is
    both changed and deleted stays. Only the buckets that hold such keys are read and written; returns them.
    """
    spark = changes.sparkSession
    before = current(spark, root, table)
    if not before or "keys" not in before:
        raise ValueError(f"{table} is not stored by buckets")
    keys, buckets, folder = before["keys"], before["buckets"], table_path(root, table)
    declared = schema_of_json(before["schema"])
    fresh = dedupe(changes.select(declared.fieldNames()), keys)
    gone = changes.select(*keys)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(*keys))
    gone = gone.distinct()
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = sorted(r[0] for r in gone.select(bucket.alias("b")).distinct().collect())
    if not touched:
        return []
    known = {b: f for b, f in before["folders"].items() if int(b) in touched}
    held = read_table(spark, root, table, version=before | {"folders": known})
    names = [f"_gone_{n}" for n in range(len(keys))]
    out = gone.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    merged = held.join(out, same, "left_anti").unionByName(fresh)
    name = f"data-{uuid.uuid4().hex}"
    _bucketed(merged, keys, buckets).write.partitionBy(BUCKET).parquet(f"{folder}/{name}", compression=CODEC)
    made = _written(spark, f"{folder}/{name}")
    folders = {b: f for b, f in before["folders"].items() if int(b) not in touched}
    folders |= {str(b): f"{name}/{BUCKET}={b}" for b in made}
    _point(spark, root, table, before | {"version": uuid.uuid4().hex, "folders": folders}, before)
    return touched


def drop_old(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete the data folders that the current version does not name; returns their names.

    A folder of which some buckets are in use stays whole. Run it when no reader holds an older version and
    no write is under way.
    """
    found = current(spark, root, table) or {"folders": []}
    folders = found["folders"]
    used = {f.split("/")[0] for f in (folders.values() if isinstance(folders, dict) else folders)}
    folder = table_path(root, table)
    context = _file_context(spark, folder)
    names = [s.getPath().getName() for s in context.util().listStatus(_path(spark, folder))]
    old = sorted(n for n in names if n.startswith(("data-", "_pointer-")) and n not in used)
    for name in old:
        context.delete(_path(spark, f"{folder}/{name}"), True)
    return old
