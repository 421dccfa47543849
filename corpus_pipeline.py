"""The training-data pipeline: documents in, packed token sequences out.

Each stage works on all that the one before kept and is written as Parquet under ``spark.checkpoint.dir``, so a
lost executor costs the tasks of one stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import decontaminate, langid, line_dedup, near_dup, packing
from comanda.llm.common import table
from comanda.staging import stage_path, staging_scope

# Languages that the corpus is to hold; None keeps all that were learned.
LANGUAGES: frozenset[str] | None = None
# Shingles of two words find copies with scattered edits that five-word shingles miss.
SHINGLE_WORDS = 2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of ``LANGUAGES`` (None: any learned one), ``lang`` being the language they are read as.

    Texts that are null or without a letter go, and those that another language reads in no more phrases.
    """
    return langid.keep_identified(docs, langid.fit_languages(docs), LANGUAGES)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share are cut out, and ``n_chars`` follows the text; no document goes."""
    cut = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (two words, 0.8, as in op7)."""
    found = near_dup.near_duplicates(docs, words=SHINGLE_WORDS)
    kept = found.where("kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.select(F.col("doc_id").alias("_leaks")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leaks"]), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.pack(docs, packing.production_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# Cross-parsing and packing are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What the stages before it wrote is deleted once it is written."""
    docs = table(spark, sf_dir, "documents")
    result = stage_path(spark, f"pipeline-{STAGES[-1][0]}")
    with staging_scope(spark, "pipeline"):
        for name, function in STAGES:
            path = result if name == STAGES[-1][0] else stage_path(spark, f"pipeline-{name}")
            function(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
