"""Data-quality profiles: duplicates and NULLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.sources.tables import save_table


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their number. NULLs form one key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once as a whole."""
    return duplicate_keys(df, df.columns)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs of each column (NULL for a table without rows)."""
    return df.agg(*[F.sum(df[c].isNull().cast("int")).alias(c) for c in df.columns])


def null_summary(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name``, ``null_count``."""
    return null_counts(df).unpivot([], df.columns, "column_name", "null_count")


def profile_and_save(df: DataFrame, name: str, keys: Sequence[str] = ()) -> None:
    """Save ``<name>_null_summary`` and, if keys are given, ``<name>_duplicates`` to the catalog."""
    save_table(null_summary(df), f"{name}_null_summary")
    if keys:
        save_table(duplicate_keys(df, keys), f"{name}_duplicates")
