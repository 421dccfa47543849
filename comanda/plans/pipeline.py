"""The daily batch: source tables to raw, bronze, silver and the gold datasets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager
from contextvars import copy_context
from functools import partial
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from comanda.operators.cleaning import CLEANERS
from comanda.plans.churn import churn, churn_of_totals
from comanda.plans.clv import KEYS as VALUE_KEYS
from comanda.plans.clv import OPTION_COLUMNS, clv, clv_of, value_lines
from comanda.plans.locations import LINE_COLUMNS as LOCATION_COLUMNS
from comanda.plans.locations import has_busy_restaurant, locations
from comanda.plans.loyalty import loyalty, loyalty_of_totals
from comanda.plans.pricing import pricing
from comanda.plans.rfm import rfm, rfm_of_totals
from comanda.plans.sales import LINE_COLUMNS as SALES_COLUMNS
from comanda.plans.sales import sales_trends
from comanda.plans.shared import customer_totals
from comanda.schemas import RAW_TABLES, SILVER
from comanda.sources.lake import CODEC, LAYOUT, extract_tables, promote, read_layer, write_layer
from comanda.staging import small_splits, stage, staged_by, staging_scope

# Each metric: items, options -> gold dataset.
METRICS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "customer_lifetime_value": clv,
    "customer_segmentation": lambda items, _: rfm(items),
    "customer_churn_indicators": lambda items, _: churn(items),
    "loyalty_program_impact": lambda items, _: loyalty(items),
    "sales_trends": lambda items, _: sales_trends(items),
    "top_performing_locations": lambda items, _: locations(items),
    "pricing_discount_effectiveness": pricing,
}
# Order of the rows inside a file of the raw layer, which the layers above keep.
RAW_SORTED: dict[str, tuple[str, ...]] = {"order_item_options": ("ORDER_ID", "LINEITEM_ID")}
# Columns by which a dataset is stored; nearly every sales report picks one period.
PARTITIONS: dict[str, tuple[str, ...]] = {"sales_trends": ("SALES_PERIOD",)}
# Order of the rows inside a file, so that neighbours share values: the figures are its widest columns.
SORTED: dict[str, tuple[str, ...]] = {
    "sales_trends": ("SALES_PERIOD", "TOTAL_REVENUE", "AVG_ORDER_VALUE", "ITEMS_SOLD", "RESTAURANT_ID", "ITEM_CATEGORY"),
}
# Metrics that read the lines of a restaurant together.
RESTAURANT_METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales_trends": lambda lines: sales_trends(lines, dealt=True),
    "top_performing_locations": lambda lines: locations(lines, dealt=True),
}
RESTAURANT_COLUMNS = tuple(dict.fromkeys((*SALES_COLUMNS, *LOCATION_COLUMNS)))
# Metrics that can start from the totals of each customer.
CUSTOMER_METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customer_segmentation": rfm_of_totals,
    "customer_churn_indicators": churn_of_totals,
    "loyalty_program_impact": loyalty_of_totals,
}


def layer(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _all_at_once(spark: SparkSession, steps: Mapping[str, Callable[[], None]]) -> None:
    """Run independent writes from driver threads, so small jobs fill the gaps of large ones.

    Jobs share the cluster fairly if the session's scheduler is fair. The first failure cancels
    the jobs of the other steps.
    """
    if not steps:
        return
    context, tag = spark.sparkContext, f"steps-{uuid4().hex}"

    def tagged(step: Callable[[], None]) -> Callable[[], None]:
        def run() -> None:
            context.addJobTag(tag)
            try:
                step()
            except BaseException:
                context.cancelJobsWithTag(tag)
                raise
            finally:
                context.removeJobTag(tag)

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(copy_context().run, tagged(step)) for step in steps.values()]
        for step in started:
            step.result()


def build_silver(spark: SparkSession, bronze_root: str, silver_root: str) -> None:
    def step(table: str) -> Callable[[], None]:
        return lambda: write_layer(
            CLEANERS[table](read_layer(spark, bronze_root, table)), silver_root, table
        )

    _all_at_once(spark, {table: step(table) for table in RAW_TABLES})


def build_gold(
    spark: SparkSession, silver_root: str, gold_root: str, metrics: Iterable[str] = tuple(METRICS)
) -> None:
    metrics = list(metrics)
    if unknown := [name for name in metrics if name not in METRICS]:
        raise KeyError(f"unknown metrics: {unknown}")
    items, options = (
        read_layer(spark, silver_root, table, SILVER[table])
        for table in ("order_items", "order_item_options")
    )

    def write(name: str, found: DataFrame) -> None:
        if name in SORTED:
            found = found.sortWithinPartitions(*SORTED[name])
        write_layer(found, gold_root, name, PARTITIONS.get(name, ()))

    def direct(name: str) -> Callable[[], None]:
        return lambda: write(name, METRICS[name](items, options))

    def dealt(df: DataFrame, label: str, keys: Sequence[str]) -> AbstractContextManager[DataFrame]:
        return staged_by(df, label, keys, compression=CODEC, **LAYOUT)

    def value() -> None:
        met = options.select(*OPTION_COLUMNS).dropna(subset=list(VALUE_KEYS))  # NULL meets no line
        with (
            dealt(value_lines(items), "value-lines", VALUE_KEYS) as lines,
            dealt(met, "value-options", VALUE_KEYS) as known,
        ):
            write("customer_lifetime_value", clv_of(lines, known))

    def from_customers(names: Sequence[str]) -> None:
        totals = stage(customer_totals(items), "customers", CODEC).df
        _all_at_once(spark, {name: partial(lambda n: write(n, CUSTOMER_METRICS[n](totals)), name) for name in names})

    def from_restaurants(names: Sequence[str]) -> None:
        if has_busy_restaurant(items):
            return _all_at_once(spark, {name: direct(name) for name in names})
        with dealt(items.select(*RESTAURANT_COLUMNS), "restaurant-lines", ["RESTAURANT_ID"]) as lines:
            _all_at_once(spark, {name: partial(lambda n: write(n, RESTAURANT_METRICS[n](lines)), name) for name in names})

    steps = {name: direct(name) for name in metrics}
    if "customer_lifetime_value" in steps:
        steps["customer_lifetime_value"] = value
    groups = (("customers", CUSTOMER_METRICS, from_customers), ("restaurants", RESTAURANT_METRICS, from_restaurants))
    for label, known, shared in groups:
        names = [name for name in metrics if name in known]
        if len(names) > 1:
            steps = {name: step for name, step in steps.items() if name not in names} | {label: partial(shared, names)}
    with small_splits(spark):
        _all_at_once(spark, steps)


def run_pipeline(
    spark: SparkSession,
    source: Callable[[str], DataFrame],
    root: str,
    metrics: Iterable[str] = tuple(METRICS),
    source_tables: Iterable[str] = RAW_TABLES,
) -> dict[str, int]:
    """Extract, promote, clean and compute the metrics. Every layer replaces its last run.

    ``source`` reads a table by its source name (``dbo.order_items`` or plain ``order_items``).
    Returns the extracted row counts. Intermediate tables are deleted at the end.
    """
    raw, bronze, silver, gold = (layer(root, n) for n in ("raw", "bronze", "silver", "gold"))
    with staging_scope(spark, "batch"), small_splits(spark):
        counts = extract_tables(source, source_tables, raw, RAW_SORTED)
        promote(spark, raw, bronze, counts)
        build_silver(spark, bronze, silver)
        build_gold(spark, silver, gold, metrics)
    return counts
