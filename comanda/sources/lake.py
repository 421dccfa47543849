"""Parquet layers: raw, bronze, silver and gold folders with one sub-folder per table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from comanda.schemas import GOLD, REPORT_DATASETS, schema_of

# Of stored layers: smaller than Spark's default, as is the level than the codec's own (3).
CODEC, LEVEL = "zstd", 6
# Pages of Parquet's second version write a text as what it adds to the one before.
LAYOUT = {"parquet.compression.codec.zstd.level": LEVEL, "parquet.writer.version": "v2"}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_layer(spark: SparkSession, root: str, table: str, ddl: str | None = None) -> DataFrame:
    """Scan a table folder, with a declared schema where there is one (no footer inference).

    A declared schema also sets the order of the columns: Spark puts partition columns last.
    """
    if not ddl:
        return spark.read.parquet(table_path(root, table))
    declared = schema_of(ddl)
    return spark.read.schema(declared).parquet(table_path(root, table)).select(declared.fieldNames())


def write_layer(
    df: DataFrame, root: str, table: str, partition_by: tuple[str, ...] = ()
) -> None:
    """Replace a table folder."""
    writer = df.write.mode("overwrite").options(**LAYOUT)
    writer.parquet(table_path(root, table), partitionBy=list(partition_by) or None, compression=CODEC)


def write_counted(df: DataFrame, root: str, table: str) -> int:
    """Replace a table folder and return its row count, observed during the write."""
    seen = Observation()
    write_layer(df.observe(seen, F.count(F.lit(1)).alias("rows")), root, table)
    return seen.get["rows"]


def extract_tables(
    read: Callable[[str], DataFrame],
    names: Iterable[str],
    root: str,
    sorted_by: Mapping[str, Sequence[str]] = MappingProxyType({}),
) -> dict[str, int]:
    """Copy source tables into the raw layer, ``schema.table`` becoming ``table``.

    Each task sorts its rows of the tables in ``sorted_by``, so that neighbours share ids and files are smaller.
    Returns the row count of each. The first failure stops the extract.
    """
    counts = {}
    for name in names:
        table, df = name.rsplit(".", 1)[-1], read(name)
        if table in sorted_by:
            df = df.sortWithinPartitions(*sorted_by[table])
        counts[table] = write_counted(df, root, table)
    return counts


def promote(spark: SparkSession, source_root: str, target_root: str, tables: Iterable[str]) -> None:
    """Copy tables from one layer to the next, replacing what the target held."""
    for table in tables:
        write_layer(read_layer(spark, source_root, table), target_root, table)


def load_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Load a gold dataset for reporting; a missing folder gives an empty frame of its schema.

    ``SALES_DATE`` is a timestamp in the loaded sales dataset. Any other read error propagates.
    """
    try:
        df = read_layer(spark, root, name, GOLD[name])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema_of(GOLD[name]))
    if name == "sales_trends":
        df = df.withColumn("SALES_DATE", F.to_timestamp("SALES_DATE"))
    return df


def missing_datasets(
    spark: SparkSession, root: str, names: Iterable[str] = REPORT_DATASETS
) -> DataFrame:
    """Names of the gold datasets that have no rows."""
    empty = [(name,) for name in names if load_gold(spark, root, name).isEmpty()]
    return spark.createDataFrame(empty, "DATASET string")
