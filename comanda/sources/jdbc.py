"""Tables of a relational source over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"


def sqlserver_url(host: str, database: str, port: int = 1433) -> str:
    return f"jdbc:sqlserver://{host}:{port};databaseName={database}"


def jdbc_options(
    url: str,
    table: str,
    props: dict[str, str],
    partition_col: str | None = None,
    lower: object = None,
    upper: object = None,
    n: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. With a partition column the table is read in ``n`` ranges of it."""
    options = {
        "driver": SQLSERVER_DRIVER,
        **props,
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
    }
    if partition_col is None:
        return options
    if lower is None or upper is None or n is None:
        raise ValueError("a partitioned read needs lower, upper and n")
    return options | {
        "partitionColumn": partition_col,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(n),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str],
    partition_col: str | None = None,
    lower: object = None,
    upper: object = None,
    n: int | None = None,
) -> DataFrame:
    """Scan one table; ``lower``/``upper`` only place the cuts, no row outside them is lost."""
    options = jdbc_options(url, table, props, partition_col, lower, upper, n)
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_slices(
    spark: SparkSession, url: str, table: str, props: dict[str, str], predicates: Sequence[str]
) -> DataFrame:
    """Scan one table with one partition per predicate, for keys a range split would skew.

    The predicates must be disjoint and cover the table, NULLs included.
    """
    connection = {"driver": SQLSERVER_DRIVER, **props}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=connection)
