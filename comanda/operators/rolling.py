"""Sums over the last days, by key: a RANGE frame whose keys are dealt out by time.

Values are summed per key and day first. Days are cut into spans; the days that frames of a later span reach back to are
repeated into it, so each span of a key is summed on its own and a key with a third of all rows is many
groups. A group holds at most a span and a frame of days, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_sum(
    rows: DataFrame, key: str, day: str, value: str, out: str, days: int, span_days: int = 365
) -> DataFrame:
    """``key``, ``day`` and ``out``, the sum of ``value`` over that day and the ``days`` - 1 before it.

    One row per key and day that occurs. A NULL key is a key; rows with a NULL day are left out. NULL values add nothing; of
    NULLs alone the sum is NULL. The span sets how far a key is dealt out, not the result.
    """
    if days < 1 or span_days < 1:
        raise ValueError("days and span_days must be at least 1")
    number = F.unix_date(F.col(day).cast("date"))
    daily = rows.where(F.col(day).isNotNull()).groupBy(F.col(key).alias("_key"), number.alias("_day")).agg(
        F.sum(value).alias("_sum")
    )
    home = F.floor(F.col("_day") / span_days)
    reached = F.floor((F.col("_day") + (days - 1)) / span_days)
    laid = daily.withColumn("_home", home).withColumn("_span", F.explode(F.sequence(home, reached)))
    frame = Window.partitionBy("_key", "_span").orderBy("_day").rangeBetween(1 - days, 0)
    summed = laid.withColumn(out, F.sum("_sum").over(frame).cast(daily.schema["_sum"].dataType))
    return summed.where(F.col("_home") == F.col("_span")).select(
        F.col("_key").alias(key), F.date_from_unix_date("_day").alias(day), out
    )
