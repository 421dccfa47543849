"""Runs of days, and joins of intervals that overlap.

Runs are found without a window over a whole key: a day without a day before it begins a run, one without a day after it
ends one, and each end meets the last beginning by an as-of join. The interval join cuts intervals into buckets of
time and joins on key and bucket, so it is an equi-join that Spark can shuffle; a pair that shares several buckets is
taken in the first of them only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.operators.asof import DAY, asof_join
from comanda.operators.heavy import join_heavy

RUN = ("FIRST_DAY", "LAST_DAY", "DAYS")


def runs_of_days(df: DataFrame, day: str, keys: Sequence[str] = (), span_days: int = 365) -> DataFrame:
    """FIRST_DAY, LAST_DAY and DAYS of each run of consecutive days (dates) per ``keys``.

    Repeated days count once. A row with a NULL day belongs to no run; NULL keys are keys like any other. The span sets
    how far the days of one key are dealt out, not the result.
    """
    key = F.struct(*[F.col(k).alias(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    days = df.where(F.col(day).isNotNull()).select(key.alias("_of"), F.col(day).cast("date").alias("_day")).distinct()

    def beside(step: int) -> DataFrame:
        return days.select(F.col("_of").alias("_near"), F.date_add("_day", step).alias("_next"))

    def without(step: int) -> DataFrame:
        near = beside(step)
        return days.join(near, F.col("_of").eqNullSafe(F.col("_near")) & (F.col("_day") == F.col("_next")), "left_anti")

    firsts = without(1).withColumn("_first", F.col("_day"))
    found = asof_join(without(-1), firsts, "_of", "_day", "_first", "_first", span_days * DAY)
    return found.select(
        *[F.col("_of")[k].alias(k) for k in keys],
        F.col("_first").alias("FIRST_DAY"),
        F.col("_day").alias("LAST_DAY"),
        (F.datediff("_day", "_first") + 1).alias("DAYS"),
    )


def _bucket(moment: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(moment.cast("timestamp")) / (seconds * 1_000_000))


def overlap_join(
    rows: DataFrame,
    others: DataFrame,
    span: tuple[str, str],
    other_span: tuple[str, str],
    keys: Sequence[tuple[str, str]] = (),
    bucket_seconds: int = 30 * DAY,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Pairs of ``rows`` and ``others`` whose spans (first, last, both included) share a moment, each pair once.

    ``span`` names the columns of the first and last moment, one name twice for points in time; ``keys`` are pairs of
    columns that must be equal, NULL meeting nothing. A span with a NULL end, or whose end lies before its beginning,
    meets nothing. Column names of both sides must differ. A row is repeated once per bucket that its span
    touches: choose a bucket about as long as the spans. With ``spread``, columns that tell rows apart, buckets that hold a
    large share of ``rows`` are found first and dealt out by these columns (``join_heavy``; runs a job).
    """
    if clash := set(rows.columns) & set(others.columns):
        raise ValueError(f"both sides have {sorted(clash)}")

    def cut(df: DataFrame, ends: tuple[str, str], name: str, first: str) -> DataFrame:
        low, high = (_bucket(F.col(e), bucket_seconds) for e in ends)
        whole = df.where(F.col(ends[0]) <= F.col(ends[1])).withColumn(first, low)
        if ends[0] == ends[1]:
            return whole.withColumn(name, F.col(first))
        return whole.withColumn(name, F.explode(F.sequence(F.col(first), high)))

    left, right = cut(rows, span, "_at", "_from"), cut(others, other_span, "_other_at", "_other_from")
    # The first bucket that both touch is the later of the two in which they begin.
    exact = [F.col("_at") == F.greatest("_from", "_other_from")]
    exact += [F.col(span[0]) <= F.col(other_span[1]), F.col(other_span[0]) <= F.col(span[1])]
    on, other_on = [a for a, _ in keys] + ["_at"], [b for _, b in keys] + ["_other_at"]
    if spread:
        known = [F.col(a).isNotNull() for a in on]
        joined = join_heavy(left.where(reduce(and_, known)), right, on, other_on, spread).where(reduce(and_, exact))
    else:
        joined = left.join(right, reduce(and_, [F.col(a) == F.col(b) for a, b in zip(on, other_on)] + exact))
    return joined.drop("_at", "_from", "_other_at", "_other_from")
