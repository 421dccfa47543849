"""Column expressions of the cleaning step. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values written into the quality columns (fixed values).
MISSING_USER, VALID_USER = "MISSING_USER_ID", "VALID_USER_ID"
MISSING_CARD, VALID_CARD = "MISSING_CARD_NUMBER", "VALID_CARD_NUMBER"

MONEY_TYPE = "decimal(10,2)"


def moment(column: Column) -> Column:
    return column.try_cast("timestamp")


def calendar_day(column: Column) -> Column:
    return column.try_cast("date")


def money(column: Column) -> Column:
    return column.try_cast(MONEY_TYPE)


def whole_number(column: Column, *, from_text: bool) -> Column:
    """Integer value, fractions cut off; text such as ``"3.0"`` counts as 3."""
    if from_text:
        column = F.regexp_replace(column, r"\.\d*\s*$", "")
    return column.try_cast("int")


def truth(column: Column) -> Column:
    return column.try_cast("boolean")


def loyalty_flag(number: Column) -> Column:
    return F.coalesce(number == 1, F.lit(False))


def is_blank(column: Column) -> Column:
    return column.isNull() | (F.trim(column) == "")


def user_id_status(user_id: Column) -> Column:
    return F.when(is_blank(user_id), MISSING_USER).otherwise(VALID_USER)


def card_number_status(card: Column) -> Column:
    return F.when(is_blank(card), MISSING_CARD).otherwise(VALID_CARD)
