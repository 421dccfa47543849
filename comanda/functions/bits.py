"""Sets of numbers as bitmaps, read word by word.

Spark's bitmaps hold 32,768 numbers in 4 KB. As 512 words of 64 bits they can be merged by ``bit_or`` and asked for one bit
without a bitmap per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS, WORDS = 64, 512


def words(bits: Column) -> Column:
    """The words of a bitmap: the first byte of eight is the highest."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)),
        lambda n: F.conv(F.hex(F.substring(bits, n * 8 + 1, 8)), 16, -10).cast("bigint"),
    )


def word_of(position: Column) -> Column:
    """Number of the word that holds a position of a bitmap."""
    return F.floor(position / WORD_BITS).cast("int")


def bit_of(position: Column) -> Column:
    """Bit of the position in its word. Within a byte the lowest bit comes first."""
    return ((7 - F.floor(position % WORD_BITS / 8)) * 8 + position % 8).cast("int")


def sets_of(numbers: DataFrame, number: str) -> DataFrame:
    """The distinct numbers as ``_set`` (the number of a bitmap) and its ``_words``."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number))
    found = numbers.groupBy(F.bitmap_bucket_number(number).alias("_set")).agg(bits.alias("_bits"))
    return found.select("_set", words(F.col("_bits")).alias("_words"))


def with_member(rows: DataFrame, number: Column, sets: DataFrame, out: str) -> DataFrame:
    """Rows with the flag whether the number is in ``sets_of``, which is broadcast."""
    numbered = rows.withColumn("_number", number)
    met = numbered.join(F.broadcast(sets), F.bitmap_bucket_number("_number") == F.col("_set"), "left")
    position = F.bitmap_bit_position("_number")
    bit = F.getbit(F.element_at("_words", word_of(position) + 1), bit_of(position))
    return met.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop("_number", "_set", "_words")


def lone_bit(position: Column) -> Column:
    """The word that holds the position alone."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of(position))
