"""As-of join: for each row the last value of its key before its time.

Both sides are put together and cut into spans of time. Inside a span the last value is carried from row to row; a
row before the first value of its span takes the last value of the spans before. These are one row per key and span,
so no window runs over the rows of a whole key, and a key that holds a third of the rows is dealt out by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def asof_join(
    rows: DataFrame,
    values: DataFrame,
    key: str,
    time: str,
    value: str,
    out: str,
    span_seconds: int = 30 * DAY,
    strict: bool = False,
) -> DataFrame:
    """All ``rows`` with ``out``: ``value`` of the last of ``values`` with the key at or before the row's time.

    ``strict`` takes only those before it. A NULL key meets no value, nor does a NULL time; such rows stay, with NULL. A NULL value is a value like any other. Of several
    values at one time the greatest counts. The span sets how far a key is dealt out, not the result.
    """
    span = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (span_seconds * 1_000_000)).alias("_span")
    known = values.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    one = known.groupBy(F.col(key).alias("_key"), F.col(time).alias("_time")).agg(
        F.max(F.struct(F.col(value).alias("v"))).alias("_value")
    )
    one = one.withColumn("_span", F.floor(F.unix_micros(F.col("_time").cast("timestamp")) / (span_seconds * 1_000_000)))
    given = rows.select(F.col(key).alias("_key"), F.col(time).alias("_time"), span, F.struct("*").alias("_row"))
    # Of one time, a value comes before the row that may see it and after one that may not.
    first = 1 if strict else 0
    both = one.select("_key", "_time", "_span", "_value", F.lit(None).cast(given.schema["_row"].dataType).alias("_row"), F.lit(first).alias("_turn"))
    both = both.unionByName(
        given.where(F.col("_key").isNotNull() & F.col("_time").isNotNull()).select(
            "_key", "_time", "_span", F.lit(None).cast(one.schema["_value"].dataType).alias("_value"), "_row", F.lit(1 - first).alias("_turn")
        )
    )
    inside = Window.partitionBy("_key", "_span").orderBy("_time", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_last", F.last("_value", ignorenulls=True).over(inside)).where(F.col("_row").isNotNull())
    # One row per key and span of either side.
    ends = both.groupBy("_key", "_span").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_time"))).alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        F.col("_key").alias("_of"), F.col("_span").alias("_at"), F.last("_end", ignorenulls=True).over(earlier).alias("_before")
    )
    met = carried.join(before, (F.col("_key") == F.col("_of")) & (F.col("_span") == F.col("_at")), "left")
    found = met.select("_row.*", F.coalesce("_last", "_before")["v"].alias(out))
    without = rows.where(F.col(key).isNull() | F.col(time).isNull())
    return found.unionByName(without.withColumn(out, F.lit(None).cast(found.schema[out].dataType)))
