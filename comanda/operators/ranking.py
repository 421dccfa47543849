"""Whole-table ranks and exact quantiles without a single-partition sort.

A rank depends only on how many rows hold a smaller value, so everything here works on counts
per distinct value. Counting first merges ties before the shuffle: a value shared by a third of
the rows is one row from then on. The distinct values are range-partitioned by Spark and stored
with the number of their bucket, so the bucket of a value is decided once. A bucket is a run of values inside a
partition; small buckets share a partition, so their number asks for no more tasks. Running counts are taken
inside each bucket and shifted by the totals of the buckets below. NULL is the smallest value,
as in Spark's default sort order.

The inputs are stored tables of known size (``Staged``), which sets the number of buckets and
nothing else: every size takes the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comanda.functions.metrics import ratio
from comanda.staging import Staged, stage

ROWS_PER_BUCKET = 1_000_000
# Buckets smaller than this share a task and a file.
ROWS_PER_TASK = 100_000

COPIES, ROWS_BEFORE, VALUES_BEFORE, GROUP_ROWS = "COPIES", "ROWS_BEFORE", "VALUES_BEFORE", "GROUP_ROWS"


def _order(value: str, descending: bool) -> Column:
    return F.desc_nulls_last(value) if descending else F.asc_nulls_first(value)


def _sum_below(column: str, window: Window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def value_positions(
    source: Staged,
    value: str,
    by: Sequence[str] = (),
    *,
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per distinct value (within ``by``) with its place in the sort order.

    COPIES rows hold the value, ROWS_BEFORE rows and VALUES_BEFORE distinct values come before
    it, GROUP_ROWS rows share its ``by`` group. Runs a job: the counts are stored once, by range.
    """
    return _positions(_value_counts(source, value, by, rows_per_bucket), value, by, descending)


def _value_counts(source: Staged, value: str, by: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """COPIES of each distinct value with the bucket of its range, stored.

    The ids that Spark hands out rise by row and by partition, and leave a gap between partitions that no bucket spans.
    """
    by = list(by)
    counts = source.df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(COPIES))
    ranges = [F.asc_nulls_first(c) for c in (*by, value)]
    tasks = source.buckets(max(rows_per_bucket, ROWS_PER_TASK))
    counts = counts.repartitionByRange(tasks, *ranges).sortWithinPartitions(*ranges)
    bucket = F.floor(F.monotonically_increasing_id() / rows_per_bucket)
    return stage(counts.withColumn("_bucket", bucket), "value-counts").df


def _positions(counts: DataFrame, value: str, by: Sequence[str], descending: bool) -> DataFrame:
    by = list(by)
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    lower_buckets = Window.partitionBy(*by).orderBy(bucket_order)  # a row per bucket, never more
    offsets = (
        counts.groupBy(*by, "_bucket")
        .agg(F.sum(COPIES).alias("_rows"), F.count(F.lit(1)).alias("_values"))
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_bucket").alias("_of_bucket"),
            _sum_below("_rows", lower_buckets).alias("_rows_below"),
            _sum_below("_values", lower_buckets).alias("_values_below"),
            F.sum("_rows").over(Window.partitionBy(*by)).alias(GROUP_ROWS),
        )
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(_order(value, descending))
    placed = counts.withColumns(
        {
            "_rows_inside": _sum_below(COPIES, inside),
            "_values_inside": F.row_number().over(inside) - 1,
        }
    )
    same_bucket = placed["_bucket"] == offsets["_of_bucket"]
    for c in by:
        same_bucket = same_bucket & placed[c].eqNullSafe(offsets[f"_by_{c}"])
    return placed.join(offsets, same_bucket).select(
        *by,
        value,
        COPIES,
        (F.col("_rows_inside") + F.col("_rows_below")).alias(ROWS_BEFORE),
        (F.col("_values_inside") + F.col("_values_below")).alias(VALUES_BEFORE),
        GROUP_ROWS,
    )


def percent_rank() -> Column:
    """Percent rank of a row of ``value_positions``: rows before over the other rows, as double."""
    return F.when(F.col(GROUP_ROWS) > 1, ratio(ROWS_BEFORE, F.col(GROUP_ROWS) - 1)).otherwise(0.0)


def dense_rank() -> Column:
    return (F.col(VALUES_BEFORE) + 1).cast("bigint")


def _join_rank(
    source: Staged, value: str, out: str, rank: Column, descending: bool, rows_per_bucket: int
) -> DataFrame:
    """Rank the distinct values and join the rank back to the rows by value.

    Rows of a value with more rows than a bucket holds are dealt out by a hash of the row over as many tasks as
    their number asks for, and their rank is repeated as often. Such values number fewer than the buckets, so the list of
    them is broadcast. The stored counts are read for the ranks and once more for that list.
    """
    counts = _value_counts(source, value, (), rows_per_bucket)
    hot = counts.where(F.col(COPIES) > rows_per_bucket).select(
        F.col(value).alias("_hot_value"), F.ceil(F.col(COPIES) / rows_per_bucket).cast("int").alias("_parts")
    )
    ranks = _positions(counts, value, (), descending)
    parts = F.greatest(F.ceil(F.col(COPIES) / rows_per_bucket).cast("int"), F.lit(1))
    ranks = ranks.select(
        F.col(value).alias("_ranked_value"), rank.alias(out), F.explode(F.sequence(F.lit(1), parts)).alias("_ranked_part")
    )
    dealt = source.df.join(F.broadcast(hot), F.col(value).eqNullSafe(F.col("_hot_value")), "left")
    part = F.pmod(F.xxhash64(*source.df.columns), F.coalesce("_parts", F.lit(1))) + 1
    dealt = dealt.withColumn("_part", part.cast("int")).drop("_hot_value", "_parts")
    met = F.col(value).eqNullSafe(F.col("_ranked_value")) & (F.col("_part") == F.col("_ranked_part"))
    return dealt.join(ranks, met).drop("_ranked_value", "_part", "_ranked_part")


def global_percent_rank(
    source: Staged, value: str, out: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``percent_rank() OVER (ORDER BY value)`` over all rows; ties share a rank, NULLs come first."""
    return _join_rank(source, value, out, percent_rank(), False, rows_per_bucket)


def global_dense_rank(
    source: Staged, value: str, out: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value DESC)`` over all rows."""
    return _join_rank(source, value, out, dense_rank(), True, rows_per_bucket)


def exact_quantiles(
    source: Staged,
    value: str,
    by: Sequence[str],
    points: dict[str, float],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact quantiles of a double column per group with linear interpolation.

    NULL values are left out; a group of NULLs only keeps its row. The two values around each
    point are picked by place in one aggregate, so no task holds the values of a group.
    """
    by = list(by)
    known = source.with_df(source.df.where(F.col(value).isNotNull()))
    places = value_positions(known, value, by, rows_per_bucket=rows_per_bucket).select(
        *by,
        value,
        F.col(ROWS_BEFORE).alias("_from"),
        (F.col(ROWS_BEFORE) + F.col(COPIES)).alias("_to"),
        (F.col(GROUP_ROWS) - 1).alias("_last"),
    )

    def value_at(place: str) -> str:
        return f"max({value}) FILTER (WHERE _from <= {place} AND {place} < _to)"

    picked = []
    for name, q in points.items():
        target = f"(_last * {float(q)}D)"
        picked += [
            F.expr(f"{value_at(f'floor{target}')} AS _low_{name}"),
            F.expr(f"{value_at(f'ceil{target}')} AS _high_{name}"),
        ]
    found = places.groupBy(*by).agg(F.max("_last").alias("_last"), *picked)
    groups = source.df.select(*by).distinct()
    same_group = F.lit(True)
    for c in by:
        same_group = same_group & groups[c].eqNullSafe(found[c])
    found = groups.join(found, same_group, "left").select(*[groups[c] for c in by], *found.columns[len(by) :])
    return found.select(
        *by,
        *[
            F.expr(
                f"_low_{name} + (_high_{name} - _low_{name})"
                f" * (_last * {float(q)}D - floor(_last * {float(q)}D)) AS {name}"
            )
            for name, q in points.items()
        ],
    )
