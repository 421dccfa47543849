"""Raw to silver: dedup, casts, trims, quality flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from comanda.functions import bits
from comanda.functions import cleaning as fn
from comanda.schemas import SILVER, conform, schema_of

# Bits of the broadcast bitmap of repeated keys (16 MB).
SLOTS = 2**27
# Hashes that are counted: few of a billion keys share one, and each takes five bytes of the shuffle.
HASHES = 2**40

TEXT_COLUMNS = ("APP_NAME", "RESTAURANT_ID", "CURRENCY", "ITEM_CATEGORY", "ITEM_NAME")


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def least_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the least one, comparing the other columns in order, NULL first.

    NULL is one key. Spark turns the filter on the row number into a group limit before the
    shuffle, so each task sends one row per key at most and a key that fills a third of the
    table never meets in one task. All rows are sorted and shuffled whole: for small tables.
    """
    rest = [c for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in rest or keys])
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``least_rows`` of a large table: only rows whose key may come again are sorted and shuffled.

    One pass counts a hash of each key; those that come again are marked in a bitmap of ``SLOTS`` bits, which is
    broadcast and never larger, whatever the size of the table. A row whose slot is not marked has a key of its own
    and stays where it is. Two keys of one slot send a row more through the window, which changes no result. Reads
    ``df`` three times, so it should come from storage and give the same rows each time.
    """
    told = _repeated(df, keys, "_again")
    return told.where(~F.col("_again")).drop("_again").unionAll(least_rows(told.where("_again").drop("_again"), keys))


def _repeated(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Rows with a flag: true for every row whose key comes again, and for a few of the others."""
    hashed, slots = F.pmod(F.xxhash64(*keys), F.lit(HASHES)), F.lit(SLOTS)
    counts = df.select(hashed.alias("_hash")).groupBy("_hash").count().where("count > 1")
    again = bits.sets_of(counts.select(F.pmod("_hash", slots).alias("_slot")), "_slot")
    return bits.with_member(df, F.pmod(hashed, slots), again, out)


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns})


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fn.moment(df[c]) for c in columns})


def to_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fn.money(df[c]) for c in columns})


def to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fn.whole_number(df[c], from_text=_is_text(df, c)) for c in columns})


def to_bool(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fn.truth(df[c]) for c in columns})


def loyalty_flag(df: DataFrame) -> DataFrame:
    """IS_LOYALTY as boolean: true for 1, false for everything else, NULL and text included."""
    number = fn.whole_number(df["IS_LOYALTY"], from_text=_is_text(df, "IS_LOYALTY"))
    return df.withColumn("IS_LOYALTY", fn.loyalty_flag(number))


def id_status(df: DataFrame) -> DataFrame:
    """Trim the card number and flag missing user ids and card numbers."""
    return trim_columns(df, ["PRINTED_CARD_NUMBER"]).withColumns(
        {
            "USER_ID_STATUS": fn.user_id_status(F.col("USER_ID")),
            "CARD_NUMBER_STATUS": fn.card_number_status(F.col("PRINTED_CARD_NUMBER")),
        }
    )


def valid_lines(df: DataFrame) -> DataFrame:
    """Lines with a positive quantity (a NULL quantity is not positive)."""
    return df.where(F.col("ITEM_QUANTITY") > 0)


def singleton_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations that occur exactly once; every copy of a repeated one goes.

    Only rows that may come again are counted whole, see ``dedupe``.
    """
    told = _repeated(df.select(*columns), columns, "_again")
    counted = told.where("_again").groupBy(*columns).count().where("count = 1").drop("count")
    return told.where(~F.col("_again")).drop("_again").unionAll(counted)


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Silver order_items; columns that the schema does not name stay behind those that it names."""
    df = dedupe(raw, ["LINEITEM_ID"])
    df = trim_columns(df, TEXT_COLUMNS)
    df = parse_timestamps(df, ["CREATION_TIME_UTC"])
    df = to_int(to_money(df, ["ITEM_PRICE"]), ["ITEM_QUANTITY"])
    df = valid_lines(id_status(loyalty_flag(df)))
    return conform(df, SILVER["order_items"], keep_rest=True)


def clean_options(raw: DataFrame) -> DataFrame:
    df = trim_columns(raw, ["OPTION_GROUP_NAME", "OPTION_NAME"])
    df = to_int(to_money(df, ["OPTION_PRICE"]), ["OPTION_QUANTITY"])
    return conform(
        singleton_rows(df, schema_of(SILVER["order_item_options"]).fieldNames()),
        SILVER["order_item_options"],
    )


def clean_date_dim(raw: DataFrame) -> DataFrame:
    """Dedup on ``date_key`` as written, then parse: two spellings of one day both stay.

    Columns that the schema does not name stay behind those that it names.
    """
    df = least_rows(raw, ["date_key"])
    df = df.withColumn("date_key", fn.calendar_day(df["date_key"]))
    df = to_int(df, ["year", "month", "week"])
    df = to_bool(trim_columns(df, ["day_of_week", "holiday_name"]), ["is_weekend", "is_holiday"])
    return conform(df, SILVER["date_dim"], keep_rest=True)


CLEANERS = {
    "order_items": clean_order_items,
    "order_item_options": clean_options,
    "date_dim": clean_date_dim,
}
