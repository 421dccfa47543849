"""Queries of this package by key, and the same results as DuckDB SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import conversations, decontaminate, html_text, langid, line_dedup, merkle, near_dup, packing, pii, quality_rules, url_filter, vantage, warc
from comanda.llm.common import table
from comanda.staging import stage_path


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = stage_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    captures = warc.assemble_captures(warc.read_records(spark, archives, with_payload=False))
    return captures.select(
        warc.metadata_field("page-id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.metadata_field("refers-to-page").cast("bigint").alias("refers_to"),
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "similarity")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.production_rules(spark))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), packing.production_tokenizer())


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_digest(pii.personal_data(table(spark, folder, "documents")))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), words=2)


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    judged = quality_rules.judge(docs, quality_rules.fit_rules(docs, labels))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.fit_languages(docs))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    report, repaired = conversations.repair(conversations.damage(given))
    digests = conversations.conversation_digests(repaired).withColumnRenamed("conv_id", "_of")
    found = report.join(digests, F.col("conv_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    every = given.select(F.col("conv_id").alias("_conv")).distinct()
    whole = every.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *found.columns[1:]
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.na.fill({c: 0 for c in counts} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")

    def leaf(text: Column) -> Column:
        return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, leaf(F.col("text")), carry=[leaf(changed).alias("given")])
    found = found.withColumn("folded_root", merkle.fold(F.col("given"), F.col("left"), F.col("right")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_vantage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vantage.near_fingerprints(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_personal_data": op6_personal_data,
    "op7_near_dedup": op7_near_dedup,
    "op8_main_text": op8_main_text,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vantage_dedup": op13_vantage_dedup,
}

OP2_SQL = r"""
WITH lines AS (
    SELECT doc_id, hash(coalesce(text, '')) AS row_hash, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS dropped
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row_hash
"""

OP3_SQL = r"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'i', item_id, text FROM benchmark
), cut AS (
    SELECT kind, id, [w FOR w IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')
        IF w <> ''] AS words
    FROM texts
), sets AS (
    SELECT kind, id, [array_to_string(words[p:p + 4], ' ') FOR p IN range(1, len(words) - 3)] AS shingles
    FROM cut WHERE len(words) >= 5
), items AS (
    SELECT kind, id, unnest(shingles) AS shingle FROM sets
), pairs AS (
    SELECT DISTINCT d.id AS doc_id, i.id AS item_id
    FROM items d JOIN items i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle
), windows AS (
    SELECT doc_id, item_id, i.shingles AS b,
           unnest([d.shingles[p + 1:p + len(i.shingles)]
                   FOR p IN range(0, greatest(len(d.shingles) - len(i.shingles), 0) + 1)]) AS a
    FROM pairs JOIN sets d ON d.kind = 'd' AND d.id = doc_id JOIN sets i ON i.kind = 'i' AND i.id = item_id
), counted AS (
    SELECT doc_id, item_id, len(a) + len(b) AS n_all,
           list_sum([least(len([y FOR y IN a IF y = x]), len([y FOR y IN b IF y = x])) FOR x IN list_distinct(a)]) AS n_both
    FROM windows
)
SELECT doc_id, item_id, max(n_both::DOUBLE / (n_all - n_both)) AS similarity
FROM counted WHERE 100 * n_both >= 80 * (n_all - n_both) GROUP BY 1, 2
"""

OP4_SQL = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, row_number() OVER () AS row_no,
           translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
    FROM cut
), fits AS (
    SELECT row_no, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule,
           arg_max(rule_verdict, length(rule_host) + length(rule_path)) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY row_no
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (row_no)
"""

OP1_SQL = r"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, max(page_id) AS first FROM payloads WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first <> coalesce(page_id, -1) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> coalesce(page_id, -1) THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest AND payload_bytes >= 1000
"""

OP7_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, [w FOR w IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')
        IF w <> ''] AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN []
        WHEN len(words) = 1 THEN [words[1]]
        ELSE list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) END AS shingles
    FROM cut
), items AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both, any_value(a.n) AS na, any_value(b.n) AS nb
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs WHERE 100 * n_both >= 80 * (na + nb - n_both)
    UNION ALL SELECT b, a FROM pairs WHERE 100 * n_both >= 80 * (na + nb - n_both)
), reach(doc_id, found) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b FROM reach r JOIN links ON r.found = a
)
SELECT s.doc_id, len(shingles) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(found) AS component_id FROM reach GROUP BY 1) r ON s.doc_id = r.doc_id
"""

OP12_SQL = r"""
WITH RECURSIVE crc(digits, pos, state) AS (
    SELECT DISTINCT CAST(doc_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT digits, pos + 1, x8 FROM (
        SELECT digits, pos, xor(state, CAST(ascii(substr(digits, pos, 1)) AS BIGINT)) AS x0,
               xor(x0 >> 1, 3988292384 * (x0 & 1)) AS x1, xor(x1 >> 1, 3988292384 * (x1 & 1)) AS x2,
               xor(x2 >> 1, 3988292384 * (x2 & 1)) AS x3, xor(x3 >> 1, 3988292384 * (x3 & 1)) AS x4,
               xor(x4 >> 1, 3988292384 * (x4 & 1)) AS x5, xor(x5 >> 1, 3988292384 * (x5 & 1)) AS x6,
               xor(x6 >> 1, 3988292384 * (x6 & 1)) AS x7, xor(x7 >> 1, 3988292384 * (x7 & 1)) AS x8
        FROM crc WHERE pos <= length(digits))
), tampered AS (
    SELECT digits FROM crc WHERE pos > length(digits) AND state & 1 = 1
), parts AS (
    SELECT doc_id, source, row_number() OVER () AS row_no,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
           CASE WHEN digits IS NULL THEN text ELSE replace(text, chr(10), '') END AS changed
    FROM documents LEFT JOIN tampered ON CAST(doc_id AS VARCHAR) = digits
), leaves AS (
    SELECT doc_id, source, row_no, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS given
    FROM parts
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_no) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes(level, tree, place, n, digest) AS (
    SELECT 0, source, place, n, leaf FROM placed
    UNION ALL
    SELECT level + 1, tree, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY level, tree, place // 3, n
), subroots AS (
    SELECT tree, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place,
           count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, place, n, digest) AS (
    SELECT 0, place, n, subroot FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 3, n
), steps AS (
    SELECT level, tree, place,
           coalesce(lag(digest, 2) OVER w, '') || coalesce(lag(digest) OVER w, '') AS before,
           coalesce(lead(digest) OVER w, '') || coalesce(lead(digest, 2) OVER w, '') AS after
    FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY level, tree, place // 3 ORDER BY place)
), top_steps AS (
    SELECT level, place,
           coalesce(lag(digest, 2) OVER w, '') || coalesce(lag(digest) OVER w, '') AS before,
           coalesce(lead(digest) OVER w, '') || coalesce(lead(digest, 2) OVER w, '') AS after
    FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY level, place // 3 ORDER BY place)
), walk(row_no, level, tree, place, folded, proof) AS (
    SELECT row_no, 0, source, place, given, '' FROM placed
    UNION ALL
    SELECT row_no, w.level + 1, w.tree, w.place // 3, sha256(before || folded || after), proof || before || after
    FROM walk w JOIN steps s ON w.level = s.level AND w.tree IS NOT DISTINCT FROM s.tree AND w.place = s.place
), top_walk(row_no, level, place, folded, proof) AS (
    SELECT row_no, 0, r.place, folded, proof
    FROM walk w JOIN subroots r ON w.level = r.height AND w.tree IS NOT DISTINCT FROM r.tree
    UNION ALL
    SELECT row_no, w.level + 1, w.place // 3, sha256(before || folded || after), proof || before || after
    FROM top_walk w JOIN top_steps s ON w.level = s.level AND w.place = s.place
), ends AS (
    SELECT row_no, digest AS root, folded, proof FROM top_walk w JOIN tops t ON t.n = 1 AND w.level = t.level
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves l JOIN ends USING (row_no) JOIN subroots r ON l.source IS NOT DISTINCT FROM r.tree
"""

SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op2_line_dedup": OP2_SQL, "op3_decontaminate": OP3_SQL, "op4_url_filter": OP4_SQL, "op7_near_dedup": OP7_SQL, "op12_merkle_manifest": OP12_SQL}
