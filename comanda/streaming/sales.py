"""Daily sales kept up to date from a stream of silver lines.

Files of lines land in a folder. A stream reads the new ones, drops lines that were delivered before, and sums each
micro-batch per order and group of the daily sales. These part sums are stored in one folder per batch. They add up, so a
line of a day long past is only one more part sum: no line is too late, and no day has to be closed. Distinct orders
are the orders of a group, as part sums keep the order.

The watermark runs on the time at which a line arrives, not on the time of the order. It bounds the state that knows the
lines seen: a line delivered again within the horizon is dropped, and state of lines older than it goes. Arrival never runs
backwards, so the watermark drops no line. The state lies on disk (RocksDB) with bounded memory, unless the session names
a store of its own; a stream that began with another store goes on with it.

A batch that runs again after a failure overwrites its own folder. Readers take only batches that are written whole.
``fold`` sums the parts into one versioned table, so the number of folders stays small.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from comanda.operators.heavy import heavy_keys
from comanda.plans.rollup import KEYS
from comanda.plans.sales import TIME, with_time_of_day
from comanda.plans.shared import with_revenue
from comanda.schemas import SILVER, schema_of
from comanda.sources import versions
from comanda.sources.lake import CODEC, table_path

PARTS, TABLE, BATCH, ARRIVED = "parts", "order_sums", "BATCH", "_arrived"
SUMS = {"TOTAL_REVENUE": "decimal(38,2)", "ITEMS_SOLD": "bigint"}
HORIZON = "7 days"
# The columns of a line that its sums and its identity need; no other is read, shuffled or kept.
LINE_COLUMNS = (
    "LINEITEM_ID", "ORDER_ID", "RESTAURANT_ID", "ITEM_CATEGORY", "CREATION_TIME_UTC", "ITEM_PRICE", "ITEM_QUANTITY"
)
# Spark's default store holds all lines seen on the heap, twice. This one holds them on disk, with bounded memory a process.
STORES = "spark.sql.streaming.stateStore"
IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ON_DISK = {
    f"{STORES}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORES}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STORES}.rocksdb.boundedMemoryUsage": "true",
    f"{STORES}.rocksdb.maxMemoryUsageMB": "500",
    f"{STORES}.rocksdb.trackTotalNumberOfRows": "false",
}


def part_sums(lines: DataFrame) -> DataFrame:
    """Lines summed per group of the daily sales and order."""
    known = with_time_of_day(with_revenue(lines, "TOTAL_REVENUE")).withColumns(
        {"SALES_DATE": F.to_date(TIME), "ITEMS_SOLD": F.col("ITEM_QUANTITY")}
    )
    return _added(known)


def _added(parts: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    sums: list[Column] = [F.sum(c).cast(kind).alias(c) for c, kind in SUMS.items()]
    return parts.groupBy(*by, "ORDER_ID").agg(*sums)


def arriving_lines(
    spark: SparkSession,
    landing: str,
    horizon: str = HORIZON,
    max_files: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The stream of lines of a folder, without those whose LINEITEM_ID arrived before within the horizon.

    Of several deliveries of a line the first counts; NULL is one id, as in the batch. ``columns`` (all if not given, else
    with LINEITEM_ID) are read; a stream shuffles whatever it reads.
    """
    declared = schema_of(SILVER["order_items"])
    reader = spark.readStream.schema(StructType([declared[c] for c in columns]) if columns else declared)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.parquet(landing).withColumn(ARRIVED, F.current_timestamp())
    return lines.withWatermark(ARRIVED, horizon).dropDuplicatesWithinWatermark(["LINEITEM_ID"])


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk, if the session has Spark's default store."""
    if spark.conf.get(f"{STORES}.providerClass") != IN_MEMORY:
        yield
        return
    before = {key: spark.conf.get(key, None) for key in ON_DISK}
    try:
        for key, value in ON_DISK.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ingest_sales(
    spark: SparkSession, landing: str, root: str, horizon: str = HORIZON, max_files: int | None = None
) -> list[int]:
    """Take in all files that have landed since the last call and stop; returns the batches written.

    The progress and the state of the lines seen lie under ``root``, which must be shared storage.
    """
    written: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        part_sums(batch).write.mode("overwrite").parquet(f"{table_path(root, PARTS)}/{BATCH}={number}", compression=CODEC)
        written.append(number)

    stream = (
        arriving_lines(spark, landing, horizon, max_files, LINE_COLUMNS)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", table_path(root, "checkpoint"))
        .trigger(availableNow=True)
    )
    with _state_on_disk(spark):
        query = stream.start()  # which takes a copy of the session's settings
    query.awaitTermination()
    return written


def whole_batches(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches that are written to the end and not folded away."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, PARTS))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    done = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.toString()}/{BATCH}=*/_SUCCESS"))
    return sorted(int(status.getPath().getParent().getName().removeprefix(f"{BATCH}=")) for status in done)


def _folded(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """The folded table and the last batch in it; None and -1 before the first fold."""
    if not versions.current(spark, root, TABLE):
        return None, -1
    base = versions.read_table(spark, root, TABLE)
    # Every row holds the number of the last batch; a table without rows has folded nothing that counts.
    last = base.agg(F.max(BATCH)).first()[0]
    return base.drop(BATCH), -1 if last is None else last


def _parts(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """Part sums that count now, each once: the folded table and the batches after it; and the last batch."""
    base, last = _folded(spark, root)
    declared = part_sums(spark.createDataFrame([], schema_of(SILVER["order_items"])))
    fresh = [number for number in whole_batches(spark, root) if number > last]
    if not fresh:
        return (declared if base is None else base), last
    folders = [f"{table_path(root, PARTS)}/{BATCH}={number}" for number in fresh]
    parts = spark.read.schema(declared.schema).parquet(*folders).select(declared.columns)
    return (parts if base is None else base.unionByName(parts)), fresh[-1]


def streamed_sales(spark: SparkSession, root: str, by: Sequence[str] = KEYS) -> DataFrame:
    """Revenue, distinct orders and items as ``sales_daily`` has them, or by fewer of its columns.

    Unless a group holds a large share of the parts, they are shuffled by group alone, which serves the orders of a group
    and then their number. Runs a job, which looks for such groups.
    """
    parts, _ = _parts(spark, root)
    if by and heavy_keys(parts, by).isEmpty():
        parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)
    return _added(parts, by).groupBy(*by).agg(
        F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"),
        F.count("ORDER_ID").alias("TOTAL_ORDERS"),
        F.sum("ITEMS_SOLD").alias("ITEMS_SOLD"),
    )


def fold(spark: SparkSession, root: str) -> int:
    """Sum all parts into the next version of the folded table; returns its last batch.

    It rewrites the table, so run it now and then, between two calls of ``ingest_sales``. Folders of the parts stay for
    their readers until ``drop_folded``.
    """
    parts, last = _parts(spark, root)
    if last >= 0:
        versions.replace_table(_added(parts).withColumn(BATCH, F.lit(last)), root, TABLE)
    return last


def drop_folded(spark: SparkSession, root: str) -> list[int]:
    """Delete the batches that the folded table holds, and its older versions, once no reader needs them."""
    _, last = _folded(spark, root)
    old = [number for number in whole_batches(spark, root) if number <= last]
    for number in old:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path(root, PARTS)}/{BATCH}={number}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    versions.drop_old(spark, root, TABLE)
    return old
