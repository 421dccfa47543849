"""Delimited files and column names fit for a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Characters a table column name cannot hold (fixed value).
UNSAFE_NAME_CHARACTERS = re.compile(r"[ ,;{}()\n\t=]+")


def read_csv_table(
    spark: SparkSession, path: str, schema: str | StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header. Without a schema the types are inferred, at the price of one more pass.

    ``multi_line`` accepts line breaks inside quotes; such a file is read by one task.
    """
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def safe_name(name: str) -> str:
    return UNSAFE_NAME_CHARACTERS.sub("_", name).strip("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(safe_name, df.columns))
