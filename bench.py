"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The gold queries read a silver layer written before the clock starts, as the metric jobs do.
Each figure is the median of three runs into a sink that drops the rows, after one warm-up
round over all queries.
``--plain`` also measures the straightforward SQL plans (benchmarks/plain_plans.py), ``--more`` the ranks
in many buckets, two further metrics and the whole daily batch.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from checks.registry import QUERIES  # noqa: E402
from checks.workspace import workspace  # noqa: E402
from comanda.plans import clv, pipeline, rfm  # noqa: E402
from comanda.session import local_session  # noqa: E402

HEADLINE = (
    "silver_order_items",
    "silver_options",
    "rfm_segments",
    "clv_segments",
    "churn_indicators",
    "loyalty_impact",
    "sales_trends",
    "location_ranking",
    "pricing_effectiveness",
    "report_exec_kpis_fixed",
    "report_gap_box",
)
# Ranks in many buckets, as on a large table: rows a bucket holds.
SMALL_BUCKET = 2_000
RUNS = 3


def run_once(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def medians(builds: dict[str, Callable[[], DataFrame]]) -> dict[str, float]:
    """Every query once to warm up, then RUNS rounds over all of them."""
    taken = {name: [] for name in builds}
    for turn in range(1 + RUNS):
        for name, build in builds.items():
            elapsed = run_once(build)
            if turn:
                taken[name].append(elapsed)
    return {name: round(statistics.median(values), 4) for name, values in taken.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("comanda-bench", cpus, spark__ui__showConsoleProgress="false")
    ws = workspace(spark, folder)
    ws.items, ws.options
    builds = {name: partial(QUERIES[name], ws) for name in HEADLINE}
    if more := "--more" in sys.argv:
        for name in ("churn_order_gaps", "pricing_by_restaurant"):
            builds[name] = partial(QUERIES[name], ws)
        builds["rfm_segments_buckets"] = lambda: rfm.rfm(ws.items, rows_per_bucket=SMALL_BUCKET)
        builds["clv_segments_buckets"] = lambda: clv.clv(ws.items, ws.options, SMALL_BUCKET)
    headline = list(builds)
    if "--plain" in sys.argv:
        from benchmarks.plain_plans import PLAIN

        ws.items.createOrReplaceTempView("order_items")
        ws.options.createOrReplaceTempView("order_item_options")
        ws.raw("order_items").createOrReplaceTempView("raw_order_items")
        ws.raw("order_item_options").createOrReplaceTempView("raw_order_item_options")
        ws.gold("customer_segmentation").createOrReplaceTempView("customer_segmentation")
        ws.gold("customer_churn_indicators").createOrReplaceTempView("customer_churn_indicators")
        builds |= {f"plain:{name}": partial(plan, spark) for name, plan in PLAIN.items()}
    times = medians(builds)
    ours = {name: times[name] for name in headline}
    if more:  # once, from the source tables
        start = time.perf_counter()
        pipeline.run_pipeline(spark, ws.source, ws.scratch("batch"))
        ours["batch_end_to_end"] = round(time.perf_counter() - start, 4)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(ours.values()), 4),
        "unit": "sec",
        "queries": ours,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    plain = {n.removeprefix("plain:"): t for n, t in times.items() if n.startswith("plain:")}
    if plain:
        result["plain"] = plain
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
