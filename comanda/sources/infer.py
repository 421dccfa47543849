"""Types of text columns, found in one pass, with the cells that do not fit.

For every column one aggregate counts the cells that each type of a ladder can hold. The type that holds most
cells, the narrowest of several, is the column's if it holds all (or all but a stated share). All columns of a table are counted in
the same scan, counts are added up map-side, and only one row per task moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From narrow to wide; text holds everything. A number is no timestamp even where Spark would read it as a year.
LADDER = ("int", "bigint", "double", "date", "timestamp", "boolean")
PATTERNS = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$",
    "boolean": r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$",
}


def fits(cell: Column, kind: str) -> Column:
    """Whether the type holds the cell: its spelling is one of the type's, and the value is in range. NULL for NULL."""
    text = F.trim(cell)
    return F.when(text.isNotNull(), text.rlike(PATTERNS[kind]) & text.try_cast(kind).isNotNull())


def type_counts(text: DataFrame) -> DataFrame:
    """Per column ``column_name``, ``cells`` (those not NULL or blank) and one count per type of the ladder.

    One row per column, also of a table without rows.
    """
    blank = {c: F.nullif(F.trim(text[f"`{c}`"]), F.lit("")) for c in text.columns}
    counts = text.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(blank[c]).alias("cells"),
                *[F.count_if(fits(blank[c], kind)).alias(kind) for kind in LADDER],
            ).alias(f"_{n}")
            for n, c in enumerate(text.columns)
        ]
    )
    columns = F.array(*[F.col(f"_{n}") for n in range(len(text.columns))])
    return counts.select(F.inline(columns))


def column_types(text: DataFrame, tolerance: float = 0.0, ladder: Sequence[str] = LADDER) -> DataFrame:
    """``column_name``, ``type``, ``cells`` and ``bad_cells`` of each column.

    The type is the one that holds most cells, of several the first of the ladder, if that is all but a share of
    ``tolerance`` of them; else string. A column without a cell is a string. With a tolerance a few bad cells do not turn numbers into text; they are counted in
    ``bad_cells`` and listed by ``bad_cells``. ``ladder`` leaves types out, such as ``date`` to read dates as timestamps.
    """
    if not 0 <= tolerance < 1:
        raise ValueError("tolerance must be at least 0 and below 1")
    counts = type_counts(text)
    enough = F.col("cells") - F.floor(F.col("cells") * tolerance)
    most = F.greatest(*[F.col(name) for name in ladder]) if len(ladder) > 1 else F.col(ladder[0])
    known = (F.col("cells") > 0) & (most >= enough)
    kind = F.coalesce(*[F.when(known & (F.col(name) == most), name) for name in ladder], F.lit("string"))
    held = F.when(known, most).otherwise(F.col("cells"))
    return counts.select("column_name", kind.alias("type"), "cells", (F.col("cells") - held).alias("bad_cells"))


def types_of(text: DataFrame, tolerance: float = 0.0, ladder: Sequence[str] = LADDER) -> dict[str, str]:
    """``column_types`` as a mapping; one row per column comes to the driver."""
    found = column_types(text, tolerance, ladder).select("column_name", "type")
    return {r.column_name: r.type for r in found.collect()}


def typed(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """The table with these types; bad cells and, outside strings, blank ones are NULL. Strings are left as they are."""

    def cell(name: str) -> Column:
        column, kind = text[f"`{name}`"], types.get(name, "string")
        if kind == "string":
            return column
        return F.when(fits(column, kind), F.trim(column).try_cast(kind)).alias(name)

    return text.select(*[cell(name) for name in text.columns])


def bad_cells(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """``column_name``, ``cell`` and ``count`` of the distinct cells that do not fit their column's type."""
    kinds = {c: types.get(c, "string") for c in text.columns}
    checked = [c for c, kind in kinds.items() if kind != "string"]
    if not checked:
        return text.sparkSession.createDataFrame([], "column_name string, cell string, count bigint")

    def misfit(name: str) -> Column:
        whole = text[f"`{name}`"]
        found = F.struct(F.lit(name).alias("column_name"), whole.alias("cell"))
        return F.when(~fits(F.nullif(F.trim(whole), F.lit("")), kinds[name]), found)

    wrong = text.select(F.explode(F.array_compact(F.array(*[misfit(c) for c in checked]))).alias("_wrong"))
    return wrong.groupBy("_wrong.column_name", "_wrong.cell").agg(F.count(F.lit(1)).alias("count"))
