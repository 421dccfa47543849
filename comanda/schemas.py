"""Declared schemas of the raw, silver and gold tables, and the checks at their boundary.

Column names are the data contract between the layers and are fixed values.
Money is decimal; ratios are double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

RAW_TABLES = ("order_items", "order_item_options", "date_dim")

SILVER = {
    "order_items": """
        LINEITEM_ID string, ORDER_ID string, APP_NAME string, RESTAURANT_ID string,
        CURRENCY string, ITEM_CATEGORY string, ITEM_NAME string, CREATION_TIME_UTC timestamp,
        ITEM_PRICE decimal(10,2), ITEM_QUANTITY int, IS_LOYALTY boolean, USER_ID string,
        PRINTED_CARD_NUMBER string, USER_ID_STATUS string, CARD_NUMBER_STATUS string""",
    "order_item_options": """
        ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string,
        OPTION_PRICE decimal(10,2), OPTION_QUANTITY int""",
    "date_dim": """
        date_key date, year int, month int, week int, day_of_week string,
        is_weekend boolean, is_holiday boolean, holiday_name string""",
}

GOLD = {
    "customer_lifetime_value": """
        CUSTOMER_ID string, CUSTOMER_LIFETIME_VALUE decimal(38,2), PERCENT_RANK double,
        CLV_SEGMENT string""",
    "customer_segmentation": """
        CUSTOMER_ID string, LAST_PURCHASE_DATE timestamp, RECENCY int, FREQUENCY bigint,
        MONETARY decimal(31,2), R_SCORE int, F_SCORE int, M_SCORE int, RFM_SCORE string,
        CUSTOMER_SEGMENT string, IS_LOYALTY boolean""",
    "customer_churn_indicators": """
        CUSTOMER_ID string, LAST_ORDER_DATE timestamp, DAYS_SINCE_LAST_ORDER int,
        AVG_ORDER_GAP_DAYS double, PREVIOUS_SPEND decimal(31,2), RECENT_SPEND decimal(31,2),
        SPEND_CHANGE_PERCENT double, CHURN_STATUS string""",
    "loyalty_program_impact": """
        CUSTOMER_ID string, IS_LOYALTY boolean, TOTAL_SPEND decimal(31,2), TOTAL_ORDERS bigint,
        AVG_ORDER_VALUE double, LOYALTY_STATUS string, LIFETIME_VALUE decimal(31,2)""",
    "sales_trends": """
        SALES_DATE date, RESTAURANT_ID string, ITEM_CATEGORY string, TIME_OF_DAY string,
        TOTAL_REVENUE decimal(31,2), TOTAL_ORDERS bigint, ITEMS_SOLD bigint, SALES_PERIOD string,
        YEAR int, WEEK int, MONTH int, AVG_ORDER_VALUE double""",
    "top_performing_locations": """
        RESTAURANT_ID string, TOTAL_REVENUE decimal(31,2), TOTAL_ORDERS bigint,
        ACTIVE_DAYS bigint, FIRST_ORDER_DATE timestamp, LAST_ORDER_DATE timestamp,
        ORDERS_PER_DAY double, ACTIVE_WEEKS double, ORDERS_PER_WEEK double,
        AVG_ORDER_VALUE double, REVENUE_RANK bigint""",
    "pricing_discount_effectiveness": """
        DISCOUNT_STATUS string, TOTAL_ORDERS bigint, GROSS_REVENUE decimal(38,2),
        DISCOUNT_AMOUNT decimal(38,2), NET_REVENUE decimal(38,2), AVG_ORDER_VALUE decimal(38,2),
        REVENUE_PERCENTAGE decimal(38,2)""",
}

# Datasets the dashboard reports read; lifetime value has no report of its own.
REPORT_DATASETS = (
    "customer_segmentation",
    "customer_churn_indicators",
    "sales_trends",
    "loyalty_program_impact",
    "top_performing_locations",
    "pricing_discount_effectiveness",
)


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


class MissingColumns(ValueError):
    """The input lacks columns a report needs."""


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming the absent columns (decided on the plan alone)."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in present]
    if missing:
        raise MissingColumns(f"Missing columns: {missing}")
    return df


def conform(df: DataFrame, ddl: str, keep_rest: bool = False) -> DataFrame:
    """Select and cast to a declared schema.

    Columns that the schema does not name are left out, or appended unchanged with ``keep_rest``.
    """
    target = schema_of(ddl)
    require_columns(df, target.fieldNames())
    named = {name.lower() for name in target.fieldNames()}
    rest = [df[name] for name in df.columns if keep_rest and name.lower() not in named]
    return df.select(
        *[df[field.name].cast(field.dataType).alias(field.name) for field in target], *rest
    )
