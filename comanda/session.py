"""Session settings shared by tests and the benchmark.

On a cluster the session comes from ``spark-submit``; nothing here is needed there beyond a UTC
session time zone, which the order timestamps (``CREATION_TIME_UTC``) assume.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str, cores: int | str = 8, **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
