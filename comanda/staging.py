"""Intermediate tables on shared storage.

A result that several later steps read (one row per customer, say) is written once as Parquet
under ``spark.checkpoint.dir`` and read back. That cuts the lineage, so the line-level scan and
shuffle behind it run once, later steps prune columns, and a lost executor costs only the tasks
it held.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPLIT_BYTES, SPLIT = "spark.sql.files.maxPartitionBytes", 32 * 2**20


@dataclass(frozen=True)
class Staged:
    """A stored table and its row count.

    ``rows`` sizes later steps (how many buckets); no result depends on it.
    """

    df: DataFrame
    rows: int

    @classmethod
    def stored(cls, df: DataFrame) -> Staged:
        """A table that is on storage already; Parquet counts its rows from the footers."""
        return cls(df, df.count())

    def with_df(self, df: DataFrame, rows_per_row: int = 1) -> Staged:
        """A row-wise derivation of the table, with at most ``rows_per_row`` rows for each row."""
        return Staged(df, self.rows * rows_per_row)

    def buckets(self, rows_per_bucket: int) -> int:
        return max(1, math.ceil(self.rows / rows_per_bucket))


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local runs get a temporary one if it is unset."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="comanda-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


_SCOPE: ContextVar[str | None] = ContextVar("staging_scope", default=None)


def stage_path(spark: SparkSession, label: str) -> str:
    """A new folder for one table, inside the scope that is open if there is one."""
    parent = _SCOPE.get() or f"{shared_root(spark)}/comanda/{spark.sparkContext.applicationId}"
    return f"{parent}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staging_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """Stages made inside share a folder, which is deleted at the end, also after a failure.

    Results that read them must be written before. Threads see the scope if they run in a copy of
    the context.
    """
    path = stage_path(spark, label)
    before = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged_by(df: DataFrame, label: str, keys: Sequence[str], **options: str | int) -> Iterator[DataFrame]:
    """Write ``df`` dealt out by a hash of ``keys`` and give it read back, partitioned so: a bucketed table.

    Aggregates and joins by these keys (and more) then need no shuffle. Files are sorted by the keys and compressed by
    column, so the table takes a fraction of what a shuffle of its rows takes, and several steps read it. All rows of a key
    meet in one task: none may hold a large share of them. A task sorts what it reads, see ``small_splits``.
    The table leaves the catalog at the end, its files go with their scope.
    """
    spark = df.sparkSession
    path, name = stage_path(spark, label), f"{label.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").options(path=path, **options)
    try:
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in splits of ``SPLIT`` at most, few enough rows of a well compressed table to be sorted in memory."""
    before = spark.conf.get(SPLIT_BYTES)
    # The session's limit may be written with a unit, which Spark alone reads.
    known = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(SPLIT_BYTES, str(min(SPLIT, known)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def stage(df: DataFrame, label: str, codec: str | None = None) -> Staged:
    """Write ``df`` once and return it read back from storage. ``codec`` compresses it, else Spark's default."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=codec)
    return Staged(spark.read.schema(df.schema).parquet(path), seen.get["rows"])
