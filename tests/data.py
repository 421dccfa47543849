"""Small hand-written tables for the tests."""

from comanda.schemas import SILVER, schema_of

T0 = "2023-06-30 12:00:00"


def items(spark, rows):
    """Silver order_items from dicts; a column not given gets a plain value."""
    plain = dict(
        LINEITEM_ID=None, ORDER_ID="o1", APP_NAME="app", RESTAURANT_ID="r1", CURRENCY="USD",
        ITEM_CATEGORY="food", ITEM_NAME="dish", CREATION_TIME_UTC=T0, ITEM_PRICE="10.00",
        ITEM_QUANTITY=1, IS_LOYALTY=False, USER_ID="u1", PRINTED_CARD_NUMBER=None,
        USER_ID_STATUS="VALID_USER_ID", CARD_NUMBER_STATUS="MISSING_CARD_NUMBER",
    )
    schema = schema_of(SILVER["order_items"])
    full = [{**plain, "LINEITEM_ID": f"l{i}", **row} for i, row in enumerate(rows)]
    return _typed(spark, full, schema)


def options(spark, rows):
    plain = dict(ORDER_ID="o1", LINEITEM_ID="l0", OPTION_GROUP_NAME="g", OPTION_NAME="n",
                 OPTION_PRICE="1.00", OPTION_QUANTITY=1)
    full = [{**plain, **row} for row in rows]
    return _typed(spark, full, schema_of(SILVER["order_item_options"]))


def _typed(spark, rows, schema):
    text = ", ".join(f"`{f.name}` string" for f in schema)
    values = [
        tuple(None if row[f.name] is None else str(row[f.name]) for f in schema) for row in rows
    ]
    df = spark.createDataFrame(values, text)
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema])


def by_key(df, key="CUSTOMER_ID"):
    return {row[key]: row for row in df.collect()}
