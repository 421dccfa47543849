"""Joins that know their heavy keys.

One pass with a frequent-items sketch finds the keys that hold a large share of the rows. Only these are salted: their
rows are dealt out over several tasks by a column of the row, and the other side's rows of these keys are
repeated as often. All other keys join as usual, and nothing depends on adaptive execution. The list of heavy keys is
broadcast; it has at most ``HEAVY_KEYS`` rows whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.staging import stage

# Every key with a share of 1 / PARTS of the rows is found: the sketch tracks far more keys than there can be such.
PARTS, HEAVY_KEYS, TRACKED = 200, 1_000, 16_384


def heavy_keys(rows: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """``_key`` (a hash of the key) and ``_salts`` of each key with more than a ``parts``-th of the rows.

    Two keys of one hash are salted alike, which changes no result. Runs a job.
    """
    if not 1 < parts <= HEAVY_KEYS:
        raise ValueError(f"parts must be between 2 and {HEAVY_KEYS}")
    hashed = rows.select(F.xxhash64(*keys).alias("_hash"))
    found = hashed.agg(
        F.expr(f"approx_top_k(_hash, {HEAVY_KEYS}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_rows")
    )
    each = found.select(F.explode("_top").alias("_one"), "_rows")
    share = F.col("_one.count") * parts / F.col("_rows")
    heavy = each.where(share > 1).select(F.col("_one.item").alias("_key"), F.ceil(share).cast("int").alias("_salts"))
    return stage(heavy, "heavy-keys").df


def join_heavy(
    rows: DataFrame,
    others: DataFrame,
    keys: Sequence[str],
    other_keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    parts: int = PARTS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Rows joined to ``others`` (inner, left, left_semi or left_anti); NULL keys are equal.

    Rows of a key that holds more than a ``parts``-th of all are dealt out by the hash of the ``spread`` columns, which should
    tell rows of one key apart and stay the same when a task runs again. The columns of ``others`` must
    have other names than those of ``rows``. Reads ``rows`` twice, unless ``heavy`` gives what ``heavy_keys`` found in
    them, or in rows with the same keys, before.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of the other side are repeated, so {how} is not possible")
    heavy = F.broadcast(heavy_keys(rows, keys, parts) if heavy is None else heavy)

    def with_salts(side: DataFrame, by: Sequence[str]) -> DataFrame:
        return side.join(heavy, F.xxhash64(*by) == F.col("_key"), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    left = with_salts(rows, keys).withColumn("_salt", F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int"))
    left = left.drop("_key", "_salts")
    right = with_salts(others, other_keys).withColumn("_other_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    right = right.drop("_key", "_salts")
    equal: list[Column] = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, other_keys)]
    met = reduce(lambda a, b: a & b, [*equal, F.col("_salt") == F.col("_other_salt")])
    joined = left.join(right, met, how)
    return joined.drop("_salt", "_other_salt")
