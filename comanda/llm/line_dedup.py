"""Removal of lines that many documents share.

Lines are exploded, trimmed, lower-cased (A-Z) and hashed to 128 bits. The distinct documents of each hash are
counted in two steps, by (hash, document) and then by hash, both after partial sums, so a line that a third of
all documents hold never meets in one task. Hashes at the threshold are stored (few against all lines) and
joined back to the lines; the positions to drop are gathered per document and the text is put together again
by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import lower_az, row_key, trimmed
from comanda.staging import stage

HASHES = ["_h1", "_h2"]


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: document, row, position and hash of the key."""
    exploded = docs.select("_id", "_row", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    long_enough = exploded.select("_id", "_row", "_pos", trimmed(F.col("_line")).alias("_key")).where(
        F.char_length("_key") >= min_chars
    )
    key = lower_az(F.col("_key"))
    return long_enough.select(
        "_id", "_row", "_pos", F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit(1), key).alias("_h2")
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """All columns of ``docs`` with the text cleaned, and ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines
    except in the largest id that holds it.

    Null or empty text is one empty line and comes back as the empty string. A null id is no document: it adds
    nothing to a count and keeps no line. Rows with one id are one document in the counts, and each keeps its
    lines if that id is the largest. Columns named ``n_lines`` or ``n_dropped`` are replaced, others pass
    through. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = docs.select(F.col(id_col).alias("_id"), row_key(text).alias("_row"), text.alias("_text"))
    lines = _lines(thin, min_chars)
    shared = (
        lines.groupBy(*HASHES)
        .agg(F.count_distinct("_id").alias("_docs"), F.max("_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .drop("_docs")
    )
    shared = stage(shared, "repeated-lines").df
    dropped = (
        lines.join(shared, HASHES)
        .where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_row")
        .agg(F.collect_set("_pos").alias("_dropped"))
        .select(F.col("_id").alias("_of"), F.col("_row").alias("_of_row"), "_dropped")
    )
    whole = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_id"), row_key(text).alias("_row"))
    joined = whole.join(
        dropped, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row")), "left"
    )
    cut = F.split(F.coalesce(F.col("_doc").getField(text_col), F.lit("")), "\n", -1)
    joined = joined.select("_doc", "_dropped", cut.alias("_cut"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_cut") - 1), F.col("_dropped"))
    kept = F.when(F.col("_dropped").isNull(), F.col("_cut")).otherwise(
        F.transform(stays, lambda at: F.col("_cut")[at])
    )
    made = {
        text_col: F.array_join(kept, "\n"),
        "n_lines": F.size("_cut").cast("long"),
        "n_dropped": F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long"),
    }
    names = [c for c in docs.columns if c not in made or c == text_col]
    columns = [made.get(c, F.col("_doc").getField(c)).alias(c) for c in names]
    return joined.select(*columns, *[made[c].alias(c) for c in ("n_lines", "n_dropped")])
