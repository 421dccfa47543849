"""Every query by key: a function of the session and a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from checks.workspace import Workspace, workspace
from comanda.functions.metrics import days_since
from comanda.operators import cleaning, profiling, quantiles, ranking
from comanda.plans import (
    churn,
    clv,
    locations,
    loyalty,
    occasions,
    pipeline,
    pricing,
    reports,
    rfm,
    rollup,
    sales,
    shared,
)
from comanda.schemas import GOLD, RAW_TABLES, REPORT_DATASETS, require_columns
from comanda.sources import files, infer, lake, tables, versions
from comanda.staging import stage
from comanda.streaming import sales as streamed

# Rows a bucket of the ranks holds in the rows named "large": many buckets, as on a large table.
SMALL_BUCKET = 20
CUSTOMER_LINES = ["CUSTOMER_ID", "ORDER_ID", "LINEITEM_ID"]


def _extract(ws: Workspace) -> str:
    """All source tables extracted in one call."""
    root = ws.scratch("raw")
    names = [f"dbo.{table}" for table in RAW_TABLES]
    lake.extract_tables(lambda name: ws.source(name.split(".")[-1]), names, root)
    return root


def _extracted(table: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: lake.read_layer(ws.spark, ws.once("extract", _extract), table)


def _promote(ws: Workspace) -> str:
    bronze = ws.scratch("bronze")
    lake.promote(ws.spark, ws.once("extract", _extract), bronze, RAW_TABLES)
    return bronze


def _promoted(table: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: lake.read_layer(ws.spark, ws.once("promote", _promote), table)


ORDERS = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,
    o_orderpriority string"""


def _scan(ws: Workspace) -> DataFrame:
    return lake.read_layer(ws.spark, ws.folder, "orders.parquet", ORDERS)


def _gold_roundtrip(ws: Workspace) -> DataFrame:
    root = ws.scratch("gold")
    lake.write_layer(sales.sales_trends(ws.items), root, "sales_trends", ("SALES_PERIOD",))
    return lake.read_layer(ws.spark, root, "sales_trends")


def _gold_replaced(ws: Workspace) -> DataFrame:
    """The second version of a dataset that was stored once before."""
    root, trends = ws.scratch("versions"), sales.sales_trends(ws.items)
    versions.replace_table(trends.where("SALES_PERIOD = 'DAILY'"), root, "sales_trends")
    versions.replace_table(trends, root, "sales_trends", ["SALES_PERIOD"])
    return versions.read_table(ws.spark, root, "sales_trends", GOLD["sales_trends"])


def _silver_merged(ws: Workspace) -> DataFrame:
    """Silver lines in two batches: a fifth comes with the second, which also corrects another fifth."""
    root, fifth = ws.scratch("versions"), F.pmod(F.xxhash64("LINEITEM_ID"), F.lit(5))
    first = ws.items.where(fifth > 0).withColumn(
        "ITEM_PRICE", F.when(fifth == 1, F.lit(0)).otherwise(F.col("ITEM_PRICE")).cast("decimal(10,2)")
    )
    versions.replace_table(first, root, "order_items", keys=["LINEITEM_ID"], buckets=16)
    versions.merge_table(ws.items.where(fifth < 2), root, "order_items")
    return versions.read_table(ws.spark, root, "order_items")


def _order_sets(ws: Workspace) -> DataFrame:
    return ws.once("order-sets", lambda ws: rollup.staged_sets(ws.items).df)


def _sketched(ws: Workspace) -> DataFrame:
    """Sales from sketches; NEAR says that the orders lie within four standard errors of the exact count."""
    found = rollup.sketched_sales(rollup.sales_states(ws.items), ["RESTAURANT_ID"])
    exact = rollup.exact_orders(_order_sets(ws), ["RESTAURANT_ID"])
    error = F.abs(F.col("APPROX_ORDERS") - F.col("TOTAL_ORDERS"))
    near = error <= F.ceil(4 * 1.04 / 2 ** (rollup.LG_K / 2) * F.col("TOTAL_ORDERS"))
    return found.join(exact, "RESTAURANT_ID").select("RESTAURANT_ID", "TOTAL_REVENUE", "ITEMS_SOLD", near.alias("NEAR"))


def _streamed(ws: Workspace) -> DataFrame:
    """Daily sales from lines that land in two deliveries. The second brings lines of all days, a third of them late ones and
    the rest lines that were delivered before; the sums of the first are folded in between."""
    landing, root, third = ws.scratch("landing"), ws.scratch("streamed"), F.pmod(F.xxhash64("LINEITEM_ID"), F.lit(3))
    # Four files, written by tasks that each read a quarter: whole lines need no shuffle.
    ws.items.where(third > 0).coalesce(4).write.parquet(landing, compression=lake.CODEC)
    streamed.ingest_sales(ws.spark, landing, root, max_files=2)
    streamed.fold(ws.spark, root)
    ws.items.where((third == 0) | (third == 1)).write.mode("append").parquet(landing, compression=lake.CODEC)
    streamed.ingest_sales(ws.spark, landing, root)
    return streamed.streamed_sales(ws.spark, root).withColumn("SALES_PERIOD", F.lit("DAILY"))


def _csv(ws: Workspace) -> DataFrame:
    folder, raw = ws.scratch("csv"), ws.raw("order_item_options")
    raw.write.csv(folder, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False)
    return files.read_csv_table(ws.spark, folder, raw.schema)


def _csv_inferred(table: str) -> Callable[[Workspace], DataFrame]:
    """A source file written as CSV and read back with the types that Spark finds."""

    def read(ws: Workspace) -> DataFrame:
        folder = ws.scratch("csv")
        ws.raw(table).write.csv(folder, header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                ignoreTrailingWhiteSpace=False)
        return files.read_csv_table(ws.spark, folder)

    return read


def _csv_text(ws: Workspace, table: str) -> DataFrame:
    """A source file written as CSV and read back as text."""
    folder, raw = ws.scratch("csv"), ws.raw(table)
    raw.write.csv(folder, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_csv_table(ws.spark, folder, ", ".join(f"`{c}` string" for c in raw.columns))


def _csv_typed(table: str) -> Callable[[Workspace], DataFrame]:
    """The text with types found by one aggregate; dates become timestamps, as Spark's own inference reads them."""

    def read(ws: Workspace) -> DataFrame:
        text = _csv_text(ws, table)
        return infer.typed(text, infer.types_of(text, ladder=[kind for kind in infer.LADDER if kind != "date"]))

    return read


def _csv_bad_cells(ws: Workspace) -> DataFrame:
    """Cells that do not fit their column, where a tenth of them may be bad."""
    text = _csv_text(ws, "order_items")
    return infer.bad_cells(text, infer.types_of(text, tolerance=0.1))


# Names that the sanitiser has to mend, and the column behind each.
ODD_NAMES = {
    "l_orderkey": "order key",
    "l_partkey": "part,key",
    "l_suppkey": "supp;key",
    "l_linenumber": "(line number)",
    "l_quantity": "{quantity}",
    "l_extendedprice": "price=extended",
    "l_discount": "dis\tcount",
    "l_tax": "tax\n",
    "l_returnflag": " return (flag) ",
    "l_linestatus": "status",
    "l_shipdate": "\tship=date\n",
}


def _sanitize(ws: Workspace) -> DataFrame:
    lines = lake.read_layer(ws.spark, ws.folder, "lineitem.parquet")
    return files.sanitize_columns(lines.select([F.col(c).alias(ODD_NAMES[c]) for c in lines.columns]))


def _table(ws: Workspace) -> DataFrame:
    path = ws.scratch("table")
    name = "comanda_" + path.rsplit("-", 1)[-1]
    found = profiling.duplicate_keys(ws.raw("order_item_options"), ["ORDER_ID"])
    tables.save_table(found, name, path)
    return tables.read_table(ws.spark, name)


# Conditions under which a stored dataset keeps rows or not; SQL counts the same (oracles.KEPT).
KEPT = {
    "customer_segmentation": "FREQUENCY >= 1",
    "customer_churn_indicators": "DAYS_SINCE_LAST_ORDER < 0",
    "sales_trends": "TOTAL_ORDERS >= 1",
    "loyalty_program_impact": "TOTAL_ORDERS > 1000000",
    "top_performing_locations": "TOTAL_ORDERS >= 1",
    "pricing_discount_effectiveness": "TOTAL_ORDERS = 0",
}


def _availability(ws: Workspace) -> DataFrame:
    root = ws.scratch("gold")
    for name in REPORT_DATASETS:
        lake.write_layer(ws.gold(name).where(KEPT[name]), root, name)
    return lake.missing_datasets(ws.spark, root)


PROFILE_KEYS = {"order_items": ["LINEITEM_ID"], "order_item_options": ["ORDER_ID"], "date_dim": ["date_key"]}


def _profiles(ws: Workspace) -> str:
    """Profiles of the three source tables, saved to the catalog."""
    prefix = "comanda_" + ws.scratch("profile").rsplit("-", 1)[-1]
    for table, keys in PROFILE_KEYS.items():
        profiling.profile_and_save(ws.raw(table), f"{prefix}_{table}", keys)
    return prefix


def _saved_nulls(ws: Workspace) -> DataFrame:
    prefix = ws.once("profiles", _profiles)
    parts = [
        tables.read_table(ws.spark, f"{prefix}_{table}_null_summary").select(
            F.lit(table).alias("TABLE_NAME"), "column_name", "null_count"
        )
        for table in PROFILE_KEYS
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _saved_duplicates(ws: Workspace) -> DataFrame:
    prefix = ws.once("profiles", _profiles)
    parts = [
        tables.read_table(ws.spark, f"{prefix}_{table}_duplicates").select(
            F.lit(table).alias("TABLE_NAME"), F.col(keys[0]).alias("KEY_VALUE"), "count"
        )
        for table, keys in PROFILE_KEYS.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _validated(ws: Workspace) -> DataFrame:
    wanted = ["o_orderkey", "O_CUSTKEY", "o_totalprice"]
    orders = lake.read_layer(ws.spark, ws.folder, "orders.parquet")
    return require_columns(orders, wanted).select("o_orderkey", "o_custkey", "o_totalprice")


def _batch(ws: Workspace) -> str:
    """The whole daily batch; returns the root of its gold layer."""
    root = ws.scratch("lake")
    pipeline.run_pipeline(ws.spark, lambda t: ws.source(t.split(".")[-1]), root,
                          source_tables=[f"dbo.{t}" for t in RAW_TABLES])
    return pipeline.layer(root, "gold")


def _from_batch(name: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: lake.read_layer(ws.spark, ws.once("batch", _batch), name, GOLD[name])


def _pipeline(ws: Workspace) -> DataFrame:
    gold = ws.once("batch", _batch)
    counts = [
        lake.read_layer(ws.spark, gold, name).agg(
            F.lit(name).alias("DATASET"), F.count(F.lit(1)).alias("ROW_COUNT")
        )
        for name in pipeline.METRICS
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result


def _days_since(ws: Workspace) -> DataFrame:
    lines = shared.with_customer(ws.items)
    now = shared.reference_date(lines).scalar()
    return lines.select("LINEITEM_ID", days_since("CREATION_TIME_UTC", now).alias("DAYS"))


def _percent_rank(ws: Workspace) -> DataFrame:
    orders = stage(
        lake.read_layer(ws.spark, ws.folder, "orders.parquet").select("o_orderkey", "o_totalprice"),
        "ranked",
    )
    return ranking.global_percent_rank(orders, "o_totalprice", "PERCENT_RANK", 4_000)


def _gap_quantiles(ws: Workspace) -> DataFrame:
    """Quartiles per status merged from sketches per status and last day; NEAR says that their ranks are.

    A reading is within one error in 99 of 100 cases and, the sketches being random, three are allowed.
    """
    gaps, points = _churn(ws), {"LEAST": 0.0, "Q1": 0.25, "MEDIAN": 0.5, "Q3": 0.75, "MOST": 1.0}
    daily = quantiles.quantile_states(
        gaps.withColumn("_day", F.to_date("LAST_ORDER_DATE")), "AVG_ORDER_GAP_DAYS", ["CHURN_STATUS", "_day"]
    )
    read = quantiles.quantiles(quantiles.merged_states(daily, ["CHURN_STATUS"]), points, ["CHURN_STATUS"])
    met = gaps.select(F.col("CHURN_STATUS").alias("_status"), F.col("AVG_ORDER_GAP_DAYS").alias("_gap")).join(
        read, F.col("_status") == F.col("CHURN_STATUS")
    )
    slack = 3 * quantiles.rank_error()
    near = F.lit(True)
    for name, point in points.items():
        below, upto = F.count_if(F.col("_gap") < F.col(name)), F.count_if(F.col("_gap") <= F.col(name))
        near &= (below <= (point + slack) * F.count("_gap")) & (upto >= (point - slack) * F.count("_gap"))
    return met.groupBy("CHURN_STATUS", "ROWS", "LEAST", "MOST").agg(near.alias("NEAR"))


def _segmentation(ws: Workspace) -> DataFrame:
    return ws.gold("customer_segmentation")


def _churn(ws: Workspace) -> DataFrame:
    return ws.gold("customer_churn_indicators")


def _sales(ws: Workspace) -> DataFrame:
    return ws.gold("sales_trends")


def _loyalty(ws: Workspace) -> DataFrame:
    return ws.gold("loyalty_program_impact")


def _locations(ws: Workspace) -> DataFrame:
    return ws.gold("top_performing_locations")


def _locations_as_text(ws: Workspace) -> DataFrame:
    """The figures as text, some of them no number."""
    orders = F.when(F.col("TOTAL_ORDERS") % 7 == 0, "n/a").otherwise(F.col("TOTAL_ORDERS").cast("string"))
    text = _locations(ws).withColumn("TOTAL_ORDERS", orders)
    return text.withColumns({c: text[c].cast("string") for c in ("TOTAL_REVENUE", "ORDERS_PER_DAY")})


def _pricing(ws: Workspace) -> DataFrame:
    return ws.gold("pricing_discount_effectiveness")


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """A mean of doubles depends on the order of addition in its last bits; compare six digits."""
    return df.withColumn(column, F.round(column, 6))


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    # Sources and sinks
    "extract_roundtrip": _extracted("order_items"),
    "extract_options": _extracted("order_item_options"),
    "extract_dates": _extracted("date_dim"),
    "bronze_promote": _promoted("date_dim"),
    "bronze_items": _promoted("order_items"),
    "bronze_options": _promoted("order_item_options"),
    "scan_parquet": _scan,
    "gold_roundtrip": _gold_roundtrip,
    "gold_replaced": _gold_replaced,
    "csv_ingest": _csv,
    "csv_inferred_items": _csv_inferred("order_items"),
    "csv_inferred_options": _csv_inferred("order_item_options"),
    "csv_inferred_dates": _csv_inferred("date_dim"),
    "csv_typed_items": _csv_typed("order_items"),
    "csv_typed_options": _csv_typed("order_item_options"),
    "csv_typed_dates": _csv_typed("date_dim"),
    "csv_bad_cells": _csv_bad_cells,
    "sanitize_columns": _sanitize,
    "table_roundtrip": _table,
    "load_gold_sales": _sales,
    "dataset_availability": _availability,
    "required_columns": _validated,
    # Data quality
    "dq_duplicate_rows": lambda ws: profiling.duplicate_rows(ws.raw("order_items")),
    "dq_duplicate_rows_options": lambda ws: profiling.duplicate_rows(ws.raw("order_item_options")),
    "dq_duplicate_rows_dates": lambda ws: profiling.duplicate_rows(ws.raw("date_dim")),
    "dq_duplicate_keys": lambda ws: profiling.duplicate_keys(
        ws.raw("order_item_options"), ["ORDER_ID"], "duplicate_count"
    ),
    "dq_null_counts": lambda ws: profiling.null_counts(ws.raw("order_items")),
    "dq_null_summary": lambda ws: profiling.null_summary(ws.raw("order_items")),
    "dq_saved_nulls": _saved_nulls,
    "dq_saved_duplicates": _saved_duplicates,
    # Silver
    "silver_dedupe_lineitems": lambda ws: cleaning.dedupe(ws.raw("order_items"), ["LINEITEM_ID"]),
    "silver_trim": lambda ws: cleaning.trim_columns(
        ws.raw("order_items"), cleaning.TEXT_COLUMNS
    ).select("LINEITEM_ID", *cleaning.TEXT_COLUMNS),
    "silver_casts": lambda ws: cleaning.to_int(
        cleaning.to_money(ws.raw("order_item_options"), ["OPTION_PRICE"]), ["OPTION_QUANTITY"]
    ).select("ORDER_ID", "LINEITEM_ID", "OPTION_PRICE", "OPTION_QUANTITY"),
    "silver_casts_items": lambda ws: cleaning.to_int(
        cleaning.to_money(ws.raw("order_items"), ["ITEM_PRICE"]), ["ITEM_QUANTITY"]
    ).select("LINEITEM_ID", "ORDER_ID", "ITEM_PRICE", "ITEM_QUANTITY"),
    "silver_loyalty_flag": lambda ws: cleaning.loyalty_flag(ws.raw("order_items")).select(
        "LINEITEM_ID", "IS_LOYALTY"
    ),
    "silver_id_status": lambda ws: cleaning.id_status(ws.raw("order_items")).select(
        "LINEITEM_ID", "USER_ID", "PRINTED_CARD_NUMBER", "USER_ID_STATUS", "CARD_NUMBER_STATUS"
    ),
    "silver_valid_lines": lambda ws: cleaning.valid_lines(
        cleaning.to_int(ws.raw("order_items"), ["ITEM_QUANTITY"])
    ).select("LINEITEM_ID", "ITEM_QUANTITY"),
    "silver_order_items": lambda ws: cleaning.CLEANERS["order_items"](ws.raw("order_items")),
    "silver_merged": _silver_merged,
    "silver_options": lambda ws: cleaning.clean_options(ws.raw("order_item_options")),
    "silver_date_dim": lambda ws: cleaning.clean_date_dim(ws.raw("date_dim")),
    # Building blocks
    "unified_customer": lambda ws: shared.with_customer(ws.items).select(*CUSTOMER_LINES),
    "unified_customer_fixed": lambda ws: shared.with_customer(ws.items, True).select(
        *CUSTOMER_LINES
    ),
    "line_revenue": lambda ws: shared.with_revenue(ws.items, "LINE_REVENUE").select(
        "LINEITEM_ID", "LINE_REVENUE"
    ),
    "option_revenue": lambda ws: shared.option_revenue(ws.options),
    "order_line_revenue": lambda ws: shared.order_line_revenue(ws.items, ws.options).select(
        "ORDER_ID", "LINEITEM_ID", "ITEM_REVENUE", "OPTION_REVENUE", "TOTAL_LINE_REVENUE"
    ),
    "reference_date": lambda ws: shared.reference_date(shared.with_customer(ws.items)),
    "days_since": _days_since,
    "global_percent_rank": _percent_rank,
    # Lifetime value
    "clv_totals": lambda ws: clv.clv_totals(ws.items, ws.options),
    "clv_percent_rank": lambda ws: clv.clv_ranked(ws.items, ws.options),
    "clv_segments": lambda ws: clv.clv(ws.items, ws.options),
    "clv_segments_large": lambda ws: clv.clv(ws.items, ws.options, SMALL_BUCKET),
    # Segmentation
    "rfm_base": lambda ws: rfm.rfm_base(ws.items),
    "rfm_recency": lambda ws: rfm.with_recency(stage(rfm.rfm_base(ws.items), "rfm").df),
    "rfm_scores": lambda ws: rfm.score_staged(stage(rfm.rfm_base(ws.items), "rfm")).drop(
        "LAST_PURCHASE_DATE", "IS_LOYALTY"
    ),
    "rfm_scores_large": lambda ws: rfm.score_staged(
        stage(rfm.rfm_base(ws.items), "rfm"), SMALL_BUCKET
    ).drop("LAST_PURCHASE_DATE", "IS_LOYALTY"),
    "rfm_segments": lambda ws: rfm.rfm(ws.items),
    # Churn
    "churn_last_order": lambda ws: churn.last_order(ws.items),
    "churn_order_gaps": lambda ws: churn.order_gaps(ws.items),
    "churn_avg_gap": lambda ws: churn.avg_gap(ws.items),
    "churn_avg_gap_fixed": lambda ws: churn.avg_gap(ws.items, per="order"),
    "churn_spend_periods": lambda ws: churn.spend_periods(ws.items).select(
        *CUSTOMER_LINES, "ORDER_REVENUE", "DAYS_FROM_REFERENCE", "SPEND_PERIOD"
    ),
    "churn_spend_pivot": lambda ws: churn.spend_by_period(ws.items),
    "churn_spend_change": lambda ws: churn.spend_change(ws.items),
    "churn_indicators": lambda ws: churn.churn(ws.items),
    # Loyalty
    "loyalty_base": lambda ws: loyalty.loyalty_base(ws.items),
    "loyalty_impact": lambda ws: loyalty.loyalty(ws.items),
    "loyalty_before_orders": lambda ws: loyalty.loyalty_before_orders(ws.items),
    # Sales
    "sales_date_parts": lambda ws: sales.with_date_parts(ws.items).select(
        "LINEITEM_ID", "SALES_DATE", "YEAR", "MONTH", "WEEK"
    ),
    "sales_time_of_day": lambda ws: sales.with_time_of_day(ws.items).select(
        "LINEITEM_ID", "TIME_OF_DAY"
    ),
    "sales_daily": lambda ws: sales.sales_daily(ws.items),
    "sales_daily_streamed": _streamed,
    "sales_weekly": lambda ws: sales.sales_weekly(ws.items),
    "sales_weekly_fixed": lambda ws: sales.sales_weekly(ws.items, iso_weeks=True),
    "sales_monthly": lambda ws: sales.sales_monthly(ws.items),
    "sales_trends": lambda ws: sales.sales_trends(ws.items),
    "sales_trends_fixed": lambda ws: sales.sales_trends(ws.items, iso_weeks=True),
    "sales_orders_total": lambda ws: rollup.exact_orders(_order_sets(ws)),
    "sales_orders_by_restaurant": lambda ws: rollup.exact_orders(_order_sets(ws), ["RESTAURANT_ID"]),
    "sales_orders_by_month_category": lambda ws: rollup.exact_orders(
        _order_sets(ws), ["YEAR", "MONTH", "ITEM_CATEGORY"]
    ),
    "sales_orders_sketched": _sketched,
    "sales_cube": lambda ws: rollup.sales_cube(ws.items),
    "sales_by_calendar": lambda ws: sales.sales_by_calendar(ws.items, ws.silver("date_dim")),
    "sales_by_days_off": lambda ws: occasions.sales_by_days_off(ws.items, ws.silver("date_dim")),
    "streaks_on_days_off": lambda ws: occasions.streaks_on_days_off(ws.items, ws.silver("date_dim")),
    "spend_before_orders": lambda ws: occasions.spend_before_orders(ws.items),
    # Locations
    "location_metrics": lambda ws: locations.location_metrics(ws.items),
    "location_metrics_fixed": lambda ws: locations.location_metrics(ws.items, day_grain=True),
    "location_ranking": lambda ws: locations.locations(ws.items),
    "location_ranking_large": lambda ws: locations.locations(
        ws.items, rows_per_bucket=SMALL_BUCKET
    ),
    "location_retention": lambda ws: locations.location_retention(ws.items),
    # Pricing
    "pricing_order_discounts": lambda ws: pricing.order_discounts(ws.options),
    "pricing_order_discounts_fixed": lambda ws: pricing.order_discounts(ws.options, True),
    "pricing_order_gross": lambda ws: pricing.order_gross(ws.items),
    "pricing_orders": lambda ws: pricing.pricing_orders(ws.items, ws.options),
    "pricing_effectiveness": lambda ws: pricing.pricing(ws.items, ws.options),
    "pricing_by_category": lambda ws: pricing.pricing_by(
        ws.items, ws.options, ["ITEM_CATEGORY"]
    ),
    "pricing_by_restaurant": lambda ws: pricing.pricing_by(
        ws.items, ws.options, ["RESTAURANT_ID"]
    ),
    # Reports
    "report_filter_in": lambda ws: reports.filter_in(
        reports.filter_in(_sales(ws), "RESTAURANT_ID"), "SALES_PERIOD", ["DAILY", "MONTHLY"]
    ).withColumn("SALES_DATE", F.to_date("SALES_DATE")),
    "report_filter_keep_null": lambda ws: reports.filter_in(
        _sales(ws), "MONTH", [1, 2], keep_null=True
    ).withColumn("SALES_DATE", F.to_date("SALES_DATE")),
    "report_choices": lambda ws: reports.choices(_sales(ws), "RESTAURANT_ID"),
    "report_date_range": lambda ws: reports.filter_dates(_sales(ws), "1996-03-01", "1998-06-30"),
    "report_exec_kpis": lambda ws: reports.executive_kpis(
        _segmentation(ws), _sales(ws), _churn(ws)
    ),
    "report_exec_kpis_fixed": lambda ws: reports.executive_kpis_fixed(
        _segmentation(ws), _sales(ws), _churn(ws), ws.items
    ),
    "report_seg_kpis": lambda ws: reports.segmentation_kpis(_segmentation(ws)),
    "report_segment_counts": lambda ws: reports.segment_counts(_segmentation(ws)),
    "report_segment_summary": lambda ws: reports.segment_summary(_segmentation(ws)),
    "report_segment_long": lambda ws: reports.segment_summary_long(_segmentation(ws)),
    "report_rfm_histogram": lambda ws: reports.rfm_score_histogram(_segmentation(ws)),
    "report_top_customers": lambda ws: reports.top_customers(_segmentation(ws)),
    "report_loyalty_comparison": lambda ws: reports.loyalty_comparison(_segmentation(ws)),
    "report_churn_kpis": lambda ws: reports.churn_kpis(_churn(ws)),
    "report_churn_counts": lambda ws: reports.churn_counts(_churn(ws)),
    "report_inactivity_hist": lambda ws: reports.histogram(_churn(ws), "DAYS_SINCE_LAST_ORDER"),
    "report_gap_box": lambda ws: reports.box_stats(
        _churn(ws), "CHURN_STATUS", "AVG_ORDER_GAP_DAYS"
    ),
    "report_gap_box_large": lambda ws: reports.box_stats(
        _churn(ws), "CHURN_STATUS", "AVG_ORDER_GAP_DAYS", SMALL_BUCKET
    ),
    "report_gap_quantiles": _gap_quantiles,
    "report_churn_scatter": lambda ws: reports.churn_scatter(_churn(ws)),
    "report_retention_targets": lambda ws: reports.retention_targets(_churn(ws)),
    "report_churn_spend": lambda ws: reports.churn_spend_kpi(_churn(ws), ws.items),
    "report_sales_kpis": lambda ws: _rounded(reports.sales_kpis(_sales(ws)), "AVG_ORDER_VALUE"),
    "report_sales_kpis_fixed": lambda ws: reports.sales_kpis_fixed(_sales(ws), ws.items),
    "report_monthly_revenue": lambda ws: reports.monthly_revenue(_sales(ws)),
    "report_category_revenue": lambda ws: reports.category_revenue(_sales(ws)),
    "report_top_restaurants": lambda ws: reports.top_restaurants(_sales(ws)),
    "report_time_of_day": lambda ws: reports.time_of_day_revenue(_sales(ws)),
    "report_loyalty_kpis": lambda ws: reports.loyalty_kpis(_loyalty(ws)),
    "report_loyalty_summary": lambda ws: reports.loyalty_summary(_loyalty(ws)),
    "report_loyalty_shares": lambda ws: reports.loyalty_shares(_loyalty(ws)),
    "report_loyalty_detail": lambda ws: reports.loyalty_detail(_loyalty(ws)),
    "report_coerce_numeric": lambda ws: reports.coerce_numeric(_locations_as_text(ws)).select(
        "RESTAURANT_ID", *[c for c in reports.location_numbers() if c in _locations(ws).columns]
    ),
    "report_location_kpis": lambda ws: _rounded(
        reports.location_kpis(_locations(ws)), "AVG_ORDER_VALUE"
    ),
    "report_location_kpis_weighted": lambda ws: reports.location_kpis_weighted(_locations(ws)),
    "report_location_rankings": lambda ws: reports.rank_locations(
        _locations(ws), "TOTAL_REVENUE", reports.TOP_LOCATIONS
    ),
    "report_location_revenue_ranking": lambda ws: reports.rank_locations(
        _locations(ws), "TOTAL_REVENUE"
    ),
    "report_location_order_values": lambda ws: reports.rank_locations(
        _locations(ws), "AVG_ORDER_VALUE"
    ),
    "report_location_volume": lambda ws: reports.location_volume(_locations(ws)),
    "report_location_activity": lambda ws: reports.location_activity(_locations(ws)),
    "report_pricing_kpis": lambda ws: reports.pricing_kpis(_pricing(ws)),
    "report_pricing_summary": lambda ws: reports.pricing_summary(_pricing(ws)),
    "report_pricing_detail": lambda ws: reports.pricing_detail(_pricing(ws)),
    # Pipeline
    "batch_end_to_end": _pipeline,
    **{f"batch_{name}": _from_batch(name) for name in pipeline.METRICS},
}


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns as double, the form the SQL side returns."""
    money = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return money_as_double(QUERIES[name](workspace(spark, folder)))
