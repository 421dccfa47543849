"""URL rules: expressions of each URL meet hashed rules.

A rule is a host and the beginning of a path. A URL is expanded into every suffix of its host (cut at dots)
combined with every beginning of its path that is as long as some rule's path. Expressions and rules meet on the
first 32 bits of their SHA-256, the full digest then confirms, and the longest rule that fits decides. Only
DataFrame functions are used; distinct URLs are judged once and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm.common import LOWER, UPPER

PREFIX_DIGITS = 8  # hexadecimal digits of the short hash: 32 bits
ALLOW, BLOCK = "allow", "block"

RULES_SCHEMA = "host string, path string, verdict string"

# The rules of the contract.
PRODUCTION_RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def production_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTION_RULES, RULES_SCHEMA)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for text without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.char_length(url))
    has = F.instr(url, "://") > 0
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    empty = F.lit("")
    return (
        F.when(has, F.translate(host, UPPER, LOWER)).otherwise(empty),
        F.when(has, path).otherwise(empty),
    )


def _host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."),
    )


def _digest(host: Column, path: Column) -> Column:
    """A NUL keeps host and path apart, so no other pair spells the same text."""
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule`` (host and path, else null) and ``verdict``.

    A rule fits its host and all subdomains if the path begins with its path. Of the rules that fit, the longest
    decides; of equally long ones the one with the longer host, of two verdicts on one rule the block. A URL that
    no rule fits gets ``default``, since the rules list exceptions.

    Null URLs and URLs without ``://`` have an empty host and path, and no rule fits. Rules with a null part are
    ignored. Pages that repeat or have no id each give a row. Other columns are not read. Empty tables of pages
    or rules are fine.
    """
    known = rules.select(
        F.translate(F.col("host"), UPPER, LOWER).alias("_rule_host"),
        F.col("path").alias("_rule_path"),
        F.col("verdict").alias("_rule_verdict"),
    ).dropna()
    hashed = known.withColumn("_rule_digest", _digest(F.col("_rule_host"), F.col("_rule_path"))).withColumn(
        "_short", F.substring("_rule_digest", 1, PREFIX_DIGITS)
    )
    # Lengths of rule paths: no more than a path has characters, so one small array for the whole job.
    lengths = known.agg(
        F.sort_array(F.collect_set(F.char_length("_rule_path"))).alias("_lengths")
    ).scalar()
    host, path = url_parts(F.col("_url"))
    urls = pages.select(F.col(url_col).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    parts = urls.select("_url", host.alias("_host"), path.alias("_path"), lengths.alias("_lengths"))
    beginnings = F.transform(
        F.filter("_lengths", lambda n: n <= F.char_length(F.col("_path"))),
        lambda n: F.substring(F.col("_path"), F.lit(1), n),
    )
    by_host = parts.select("_url", beginnings.alias("_paths"), F.explode(_host_suffixes(F.col("_host"))).alias("_h"))
    expressions = by_host.select("_url", "_h", F.explode("_paths").alias("_p"))
    expressions = expressions.select("_url", _digest(F.col("_h"), F.col("_p")).alias("_digest"))
    expressions = expressions.withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS))
    met = expressions.join(hashed, "_short").where(F.col("_digest") == F.col("_rule_digest"))
    rank = F.struct(
        (F.char_length("_rule_host") + F.char_length("_rule_path")).alias("n"),
        F.char_length("_rule_host").alias("host_n"),
        F.when(F.col("_rule_verdict") == BLOCK, 1).otherwise(0).alias("blocks"),
        F.concat("_rule_host", "_rule_path").alias("rule"),
        F.col("_rule_verdict").alias("verdict"),
    )
    best = met.groupBy("_url").agg(F.max(rank).alias("_best")).withColumnRenamed("_url", "_judged")
    asked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    page_host, page_path = url_parts(F.col("_url"))
    return asked.join(best, F.col("_url") == F.col("_judged"), "left").select(
        "page_id",
        page_host.alias("host"),
        page_path.alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )
