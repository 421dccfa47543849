"""Places of rows within their groups, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comanda.staging import Staged, stage

PLACE, GROUP_ROWS = "_place", "_group_rows"
ROWS_PER_PART = 200_000

# monotonically_increasing_id() keeps the partition above this bit and counts rows below it.
_PART_BIT = 33


def same(left: list[Column], right: list[Column]) -> Column:
    """All columns equal, nulls included."""
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in zip(left, right)])


def with_places(
    rows: Staged, group: Sequence[str], order: Sequence[str], rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """The rows with ``_place``, counted from 0 in each group, and ``_group_rows``; nulls come first.

    Rows are dealt out by range of group and order and stored as they lie, so a group that holds a third of all
    rows takes a third of the partitions. A row's place is its place in its run, the rows of one group in one
    partition, and the rows of the group's runs before it. Runs number at most groups plus partitions.
    Rows that are equal in group and order stand in any order. Runs a job.
    """
    by = [F.asc_nulls_first(c) for c in (*group, *order)]
    lain = rows.df.repartitionByRange(rows.buckets(rows_per_part), *by).sortWithinPartitions(*by)
    lain = stage(lain.withColumn("_at", F.monotonically_increasing_id()), "in-order").df
    part = F.shiftright("_at", _PART_BIT)
    names = [f"_of_{n}" for n in range(len(group))]
    runs = lain.groupBy(*[F.col(c).alias(n) for c, n in zip(group, names)], part.alias("_of_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_run")
    )
    whole = Window.partitionBy(*names)  # a row per partition that holds a part of the group
    below = F.sum("_run").over(whole.orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        *names,
        "_of_part",
        (F.coalesce(below, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_run").over(whole).alias(GROUP_ROWS),
    )
    met = same([part, *[F.col(c) for c in group]], [F.col("_of_part"), *[F.col(n) for n in names]])
    placed = lain.join(runs, met).withColumn(PLACE, F.col("_at") + F.col("_shift"))
    return placed.drop("_at", "_shift", "_of_part", *names)
