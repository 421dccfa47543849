"""Layers derived from a folder of star-schema tables, each written on first use.

The gold metrics read silver and the reports read gold, as in the daily batch, so a check of a
report does not clean the raw tables again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from comanda.operators.cleaning import CLEANERS
from comanda.plans.pipeline import METRICS, layer
from comanda.schemas import SILVER
from comanda.sources.lake import load_gold, read_layer, write_layer
from comanda.sources.star_adapter import raw_table
from comanda.staging import stage_path


class Workspace:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.root = stage_path(spark, "workspace")
        self._written: set[tuple[str, str]] = set()
        self._made: dict[str, str | DataFrame] = {}

    def scratch(self, label: str) -> str:
        """A new folder for one write of one query."""
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def once(self, label: str, make: Callable[[Workspace], str | DataFrame]) -> str | DataFrame:
        """What ``make`` returns, made on first use."""
        if label not in self._made:
            self._made[label] = make(self)
        return self._made[label]

    def layer_root(self, name: str) -> str:
        return layer(self.root, name)

    def source(self, table: str) -> DataFrame:
        """The table as its source system would serve it, derived anew on each use."""
        return raw_table(self.spark, self.folder, table)

    def raw(self, table: str) -> DataFrame:
        root = self.layer_root("raw")
        if ("raw", table) not in self._written:
            write_layer(self.source(table), root, table)
            self._written.add(("raw", table))
        return read_layer(self.spark, root, table)

    def silver(self, table: str) -> DataFrame:
        root = self.layer_root("silver")
        if ("silver", table) not in self._written:
            write_layer(CLEANERS[table](self.raw(table)), root, table)
            self._written.add(("silver", table))
        return read_layer(self.spark, root, table, SILVER[table])

    @property
    def items(self) -> DataFrame:
        return self.silver("order_items")

    @property
    def options(self) -> DataFrame:
        return self.silver("order_item_options")

    def gold(self, name: str) -> DataFrame:
        root = self.layer_root("gold")
        if ("gold", name) not in self._written:
            write_layer(METRICS[name](self.items, self.options), root, name)
            self._written.add(("gold", name))
        return load_gold(self.spark, root, name)


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of this application for a folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, folder)
    return _OPEN[key]
