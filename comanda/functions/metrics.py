"""Column expressions of the business metrics. Labels and limits are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMES_OF_DAY = ("Late Night", "Morning", "Afternoon", "Evening", "Night")
TIME_OF_DAY_ENDS = (6, 12, 17, 21)  # hour at which each but the last is over
RECENT_DAYS = 90
PREVIOUS_DAYS = 180


def first_match(*cases: tuple[Column, object], otherwise: object = None) -> Column:
    """CASE expression: the value of the first condition that holds."""
    result = F.when(*cases[0])
    for condition, value in cases[1:]:
        result = result.when(condition, value)
    return result.otherwise(otherwise)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; NULL when the denominator is 0."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (numerator, denominator))
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean_money(column: Column | str) -> Column:
    """Mean of a decimal column: exact sum first, one division last. NULL values do not count."""
    return ratio(F.sum(column), F.count(column))


def customer_id(blank_as_null: bool = False) -> Column:
    """User id, else card number. A blank id is an id unless ``blank_as_null``."""
    ids = [F.col("USER_ID"), F.col("PRINTED_CARD_NUMBER")]
    if blank_as_null:
        ids = [F.when(F.trim(c) != "", c) for c in ids]
    return F.coalesce(*ids)


def line_revenue() -> Column:
    return F.col("ITEM_PRICE") * F.col("ITEM_QUANTITY")


def option_value() -> Column:
    return F.col("OPTION_PRICE") * F.col("OPTION_QUANTITY")


def days_since(moment: Column | str, reference: Column) -> Column:
    """Calendar days from ``moment`` to ``reference``; the time of day does not count."""
    return F.datediff(reference, moment)


def time_of_day_number(moment: Column | str) -> Column:
    """Position in ``TIMES_OF_DAY``; an unknown time counts as the last."""
    hour = F.hour(moment)
    steps = [(hour < end, number) for number, end in enumerate(TIME_OF_DAY_ENDS)]
    return first_match(*steps, otherwise=len(TIME_OF_DAY_ENDS))


def time_of_day_label(number: Column) -> Column:
    return F.array(*map(F.lit, TIMES_OF_DAY))[number]


def time_of_day(moment: Column | str) -> Column:
    return time_of_day_label(time_of_day_number(moment))


def clv_segment(percent_rank: Column) -> Column:
    return first_match(
        (percent_rank >= 0.80, "High CLV"), (percent_rank >= 0.20, "Medium CLV"), otherwise="Low CLV"
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return first_match(
        ((r >= 4) & (f >= 4) & (m >= 4), "VIP"),
        ((r >= 4) & (f <= 2), "New Customer"),
        ((r <= 2) & (f <= 2), "Churn Risk"),
        otherwise="Regular Customer",
    )


def churn_status(days: Column) -> Column:
    return first_match((days > 90, "High Risk"), (days > 45, "At Risk"), otherwise="Active")


def spend_period(days: Column) -> Column:
    return F.when(days <= RECENT_DAYS, "RECENT").when(days <= PREVIOUS_DAYS, "PREVIOUS")


def spend_change_percent(recent: Column, previous: Column) -> Column:
    change = ratio(recent - previous, previous) * 100.0
    return F.when(previous > 0, change).otherwise(0.0)


def loyalty_status(is_loyalty: Column) -> Column:
    return F.when(is_loyalty, "LOYALTY_MEMBER").otherwise("NON_LOYALTY_MEMBER")


def discount_status(amount: Column) -> Column:
    return F.when(amount > 0, "DISCOUNTED_ORDER").otherwise("NON_DISCOUNTED_ORDER")


def null_to_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))
