"""Tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table; with ``path`` its files live there instead of in the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
