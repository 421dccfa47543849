"""Helpers shared by the text operators.

Words are runs of characters other than ``[\\x20\\x09-\\x0D]`` and case folding touches A-Z only, on the
JVM side as in Python, so both give the same result for any text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# The white space of the word definition, and the two alphabets.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_GAP = r"[\x20\x09-\x0D]+"

# Rows handed to Python work at a time, whatever the size of the Arrow batch.
CHUNK = 256
OUT_ROWS = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """A-Z in lower case. ASCII text takes the short way, as ``lower`` then means the same."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def row_key(*columns: Column) -> Column:
    """A hash of whole values. With the id beside it, it tells rows of one id apart."""
    return F.xxhash64(*columns)


def map_rows(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[[list[dict]], Iterable[tuple]]],
    chunk: int = CHUNK,
) -> DataFrame:
    """Python work over small lists of rows, inside ``mapInArrow``.

    ``start`` runs once per task and returns the function from rows to result tuples. Arrow batches are cut
    into ``chunk`` rows and results sent on every ``OUT_ROWS``, so Python holds a few hundred texts at a time
    and ``start`` may make many rows of one.
    """
    kinds = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                made = iter(work(batch.slice(at, chunk).to_pylist()))
                while rows := list(islice(made, OUT_ROWS)):
                    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, kinds)


def judge_rows(
    df: DataFrame, column: str, into: str | None, start: Callable[[], Callable[[list], list]], chunk: int = CHUNK
) -> DataFrame:
    """The rows of ``df`` to which Python gives a value from one column, without a shuffle; those given None go.

    The value replaces that of the column ``into``, if one is named. All other columns stay as they are.
    """
    arrow = to_arrow_schema(df.schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                given = work(part.column(names.index(column)).to_pylist())
                columns = [pa.array(given, f.type) if f.name == into else c.cast(f.type) for c, f in zip(part.columns, arrow)]
                made = pa.RecordBatch.from_arrays(columns, schema=arrow)
                yield made.filter(pa.array([value is not None for value in given], pa.bool_()))

    return df.mapInArrow(run, df.schema)
