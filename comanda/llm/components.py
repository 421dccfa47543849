"""Connected components by falling labels, every round written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from comanda.operators.heavy import heavy_keys, join_heavy
from comanda.staging import stage, stage_path


def met(rows: DataFrame, others: DataFrame, key: str, other_key: str, spread: str, how: str, heavy: DataFrame) -> DataFrame:
    """Rows joined to the one row of their key; heavy keys are dealt out, where there are any."""
    if heavy.isEmpty():
        return rows.join(others, F.col(key) == F.col(other_key), how)
    return join_heavy(rows, others, [key], [other_key], [spread], how, heavy=heavy)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    In each round a node takes the smallest label among its own, its neighbours' and that of its label, so long
    chains shrink fast. The neighbours' labels are reduced before the shuffle. The edges of a hub and the nodes of a large
    component are dealt out over several tasks, whatever adaptive execution does. Stops when no label falls. Links with
    a null end are ignored.
    """
    spark = links.sparkSession
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    turned = known.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = stage(known.unionByName(turned), "edges").df
    hubs = heavy_keys(edges, ["b"])
    labels = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("component"))
    labels = stage(labels.withColumnRenamed("a", "node"), "labels").df
    while True:
        far = labels.select(F.col("node").alias("_at"), F.col("component").alias("_label"))
        near = met(edges, far, "b", "_at", "a", "inner", hubs).groupBy("a").agg(F.min("_label").alias("_near"))
        jump = far.select(F.col("_at").alias("_jump"), F.col("_label").alias("_over"))
        own = labels.join(near, F.col("node") == F.col("a"), "left")
        giants = heavy_keys(labels, ["component"])
        fallen = met(own, jump, "component", "_jump", "node", "left", giants).select(
            "node", "component", F.least("component", "_near", "_over").alias("_new")
        )
        seen, path = Observation(), stage_path(spark, "labels")
        changed = F.count_if(F.col("_new") < F.col("component"))
        fallen = fallen.observe(seen, changed.alias("changed")).select("node", F.col("_new").alias("component"))
        fallen.write.parquet(path)
        labels = spark.read.schema(labels.schema).parquet(path)
        if not seen.get["changed"]:
            return labels
