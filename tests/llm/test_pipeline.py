"""The pipeline against plain Python over a small table."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comanda.llm import langid, packing
from tests.llm.data import DOCS, doc_rows, groups, line_dedup, passages, prose

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    given = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    langs = [r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    shared = prose(5, 30)
    texts = given + ["12 34", None, "", given[3] + "\n" + shared, given[9].upper()]
    texts += [f"{prose(n, 40)}\n{shared}\n{prose(n + 500, 40)}" for n in range(400, 408)]
    texts += [UNREADABLE]
    rows = [(n, t, langs[n] if n < len(langs) else None, "s", None if t is None else len(t)) for n, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{root}/benchmark.parquet")
    return root


# Letters of no learned language: every language needs a phrase for each of them.
UNREADABLE = "\u0416\u0429\u042e\u042f " * 30


def read_as(texts, samples):
    """doc -> language, by the longest phrases of a plain scan, for texts that one language reads in the fewest phrases."""
    found = {}
    for i, text in texts.items():
        letters = langid.normalised(text or "")
        bits, counts = [], []
        for _, sample in samples.texts:
            at = phrases = 0
            while at < len(letters):
                size = 1
                while at + size < len(letters) and letters[at : at + size + 1] in sample:
                    size += 1
                if letters[at] not in sample:
                    size = 1
                at, phrases = at + size, phrases + 1
            counts.append(phrases)
            bits.append(phrases * math.log2(len(sample) + 1))
        best = bits.index(min(bits))
        if letters and all(n > counts[best] for k, n in enumerate(counts) if k != best):
            found[i] = samples.texts[best][0]
    return found


def test_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    given = {r.doc_id: r.text for r in docs.collect()}
    langs = read_as(given, langid.fit_languages(docs))
    with_letters = {i for i, t in given.items() if langid.normalised(t or "")}
    assert len(with_letters - set(langs)) == 1  # a letter alone does not keep a document
    kept = {i: t for i, t in given.items() if i in langs}
    kept = {i: t for i, (t, _, _) in line_dedup(kept).items()}
    component = groups(kept, 2)
    kept = {i: t for i, t in kept.items() if component[i] == i}
    leaks = {doc for doc, _ in passages(kept, items)}
    kept = {i: t for i, t in kept.items() if i not in leaks}
    encode = packing.encoder(packing.production_tokenizer())
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(kept) and leaks
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(encode(t)) + 1 for i, t in kept.items()}


def test_the_language_stage_decides(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    langs = read_as({r.doc_id: r.text for r in docs.collect()}, langid.fit_languages(docs))
    out = corpus_pipeline.identified(spark, docs, folder).collect()
    assert {r.doc_id: r.lang for r in out} == langs
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", frozenset({"en"}))
    out = corpus_pipeline.identified(spark, docs, folder).collect()
    assert {r.doc_id for r in out} == {i for i, lang in langs.items() if lang == "en"} and len(out) < len(langs)


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, folder).schema.names == docs.schema.names


@pytest.mark.parametrize("rows", ["none", "some"])
def test_empty_tables_and_clashing_names(spark, folder, tmp_path, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.limit(0) if rows == "none" else docs.where("doc_id % 9 = 0").unionByName(docs.where("doc_id = 9"))
    names = ["_id", "_row", "_text", "n_lines", "kept", "rep", "score", "lang_pred", "_kept", "_leaks", "piece"]
    docs.withColumns({n: F.lit("clash") for n in names}).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    (bench.limit(0) if rows == "none" else bench).withColumn("doc_id", F.lit(1)).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 if rows == "none" else found.count() > 10
