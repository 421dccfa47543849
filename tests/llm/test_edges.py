"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from pyspark.sql import functions as F

from comanda.llm import (
    decontaminate,
    html_text,
    langid,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality_rules,
    url_filter,
    warc,
)
from comanda.staging import stage_path
from tests.llm.data import DOCS, doc_rows, prose

LONG = prose(1, 20_000)
TEXTS = [None, "", " \n\t ", "Hello there, general.", LONG, LONG, "Hello there, general.", "\n\n"]
CLASH = ["_id", "_row", "_text", "_doc", "n_lines", "n_dropped", "component", "rep", "node", "key", "kept", "host",
         "length", "piece", "_stays", "score", "lang_pred", "_url", "_page", "ids", "rule", "verdict"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = doc_rows(TEXTS) + [(3, "Hello there, general.", "en", "s", 1), (None, "Hello there, general.", None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({name: F.lit("clash") for name in CLASH})


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a.example.org/es/1", "<article><p>" + LONG + "</p></article>"),
        (2, None, "<article><p>" + LONG + "</p></article>"),
        (2, "no scheme", None),
        (None, "https://com/de/x?y#z", ""),
        (5, "://", "plain < text & <b>bold"),
        (5, "://", "plain < text & <b>bold"),
        (6, "http://b.com/de/\r\nX: y", "<div class='ad'>only an advert</div>"),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return frame.withColumns({name: F.lit("clash") for name in CLASH})


def ids(frame, name="doc_id"):
    return sorted((r[0] for r in frame.select(name).collect()), key=lambda i: (i is None, i))


def wanted(frame, name="doc_id"):
    return ids(frame, name)


def test_line_dedup(docs):
    out = line_dedup.drop_repeated_lines(docs)
    assert set(out.columns) == set(docs.columns)
    assert ids(out) == wanted(docs)
    assert {r.n_lines for r in out.where("doc_id = 0 or doc_id = 1").collect()} == {1}


def test_near_duplicates(docs):
    out = near_dup.near_duplicates(docs, words=2)
    assert ids(out) == wanted(docs)
    found = {(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in out.collect()}
    assert found == {
        (0, False, 0, True), (1, False, 1, True), (2, False, 2, True), (3, True, 3, True), (4, True, 4, True),
        (5, True, 4, False), (6, True, 3, False), (7, False, 7, True), (None, True, 3, False),
    }


def test_lone_null_id(spark):
    out = near_dup.near_duplicates(spark.createDataFrame([(None, "one two three")], "doc_id bigint, text string"))
    assert [tuple(r) for r in out.collect()] == [(None, 1, None, True)]


def test_pii(docs):
    out = pii.span_digest(pii.personal_data(docs))
    assert ids(out) == wanted(docs)
    assert out.where("spans <> ''").count() == 0


def test_quality(docs, spark):
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (4, None, 0), (99, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rules = quality_rules.fit_rules(docs, labels)
    assert rules == []
    out = quality_rules.judge(docs, rules)
    assert ids(out) == wanted(docs)
    assert {(r.n_words, r.base_failed) for r in out.where("doc_id <= 2").collect()} == {(0, True)}


def test_language(docs):
    samples = langid.fit_languages(docs.where("doc_id = 3").withColumn("doc_id", F.explode(F.sequence(F.lit(1), F.lit(9)))))
    out = langid.identify(docs, samples)
    assert ids(out) == wanted(docs)
    assert {r.lang_pred for r in out.where("doc_id <= 2 or doc_id = 7").collect()} == {"und"}
    kept = langid.keep_identified(docs, samples)
    assert kept.columns == docs.columns
    assert ids(kept) == [3, 3, 4, 5, 6, None]


def test_nothing_learned(docs):
    samples = langid.fit_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in langid.identify(docs, samples).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_packing(docs):
    out = packing.pack(docs, packing.production_tokenizer())
    assert ids(out.where("piece = 0")) == wanted(docs)
    assert {r.length for r in out.where("doc_id <= 1").collect()} == {1}


def test_decontaminate(docs, spark):
    items = spark.createDataFrame([(1, LONG[500:1500]), (2, "too short"), (None, None), (3, "")], "item_id bigint, text string")
    out = decontaminate.find_passages(docs, items)
    assert sorted(tuple(r)[:2] for r in out.collect()) == [(4, 1), (5, 1)]


def test_urls(pages, spark):
    out = url_filter.judge_urls(pages, url_filter.production_rules(spark))
    assert ids(out, "page_id") == wanted(pages, "page_id")
    found = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert (1, "a.example.org", "/es/1", "example.org/es/", "block") in found
    assert (2, "", "", None, "allow") in found and (5, "", "", None, "allow") in found
    assert (None, "com", "/de/x", "com/de/", "block") in found


def test_html(pages):
    out = html_text.extract(pages)
    assert ids(out, "page_id") == wanted(pages, "page_id")
    found = {r.page_id: r.text for r in out.collect()}
    assert found[1] == LONG and found[None] == "" and found[6] == "" and found[5] == "plain < text & bold"


def test_warc(pages, spark):
    path = stage_path(spark, "warc-edges")
    warc.write_archives(pages, path)
    out = warc.assemble_captures(warc.read_records(spark, path))
    assert out.count() == pages.count()
    kinds = sorted((r.record_type, r.payload_bytes) for r in out.collect() if r.payload_bytes and r.payload_bytes > 1000)
    assert [k for k, _ in kinds] == ["response", "revisit"]


@pytest.mark.parametrize("name", ["line", "near", "pii", "quality", "language", "pack", "leaks", "urls", "html"])
def test_empty_tables(spark, docs, pages, name):
    none, no_pages = docs.limit(0), pages.limit(0)
    items = spark.createDataFrame([], "item_id bigint, text string")
    out = {
        "line": lambda: line_dedup.drop_repeated_lines(none),
        "near": lambda: near_dup.near_duplicates(none),
        "pii": lambda: pii.personal_data(none),
        "quality": lambda: quality_rules.judge(none, []),
        "language": lambda: langid.identify(none, langid.fit_languages(none)),
        "pack": lambda: packing.pack(none, packing.production_tokenizer()),
        "leaks": lambda: decontaminate.find_passages(docs, items),
        "urls": lambda: url_filter.judge_urls(no_pages, url_filter.production_rules(spark).limit(0)),
        "html": lambda: html_text.extract(no_pages),
    }[name]()
    assert out.count() == 0


def test_empty_archives(spark, pages):
    path = stage_path(spark, "warc-empty")
    warc.write_archives(pages.limit(0), path)
    assert warc.assemble_captures(warc.read_records(spark, path)).count() == 0
