"""Operators against plain Python over all pairs, lines or windows of small tables."""

import random
import re
import zlib

import numpy as np
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
from comanda.llm.components import components
from comanda.staging import stage_path
from tests.llm.data import (
    DOCS,
    doc_rows,
    edited,
    groups,
    passages,
    prose,
    shingles,
    words_of,
)
from tests.llm.data import line_dedup as plain_line_dedup

FOLDER = "/root/testdata/sf0.01"


def as_docs(spark, texts):
    return spark.createDataFrame(doc_rows(texts), DOCS).repartition(3)


# Lines


def test_line_dedup(spark):
    rng = random.Random(5)
    lines = [prose(n, 8) for n in range(12)] + ["short line", "", "É" + "x" * 39, "É" + "x" * 38, " A" + "b" * 40]
    texts = ["\n".join(rng.choice([x, x.upper(), f"\t{x} "]) for x in rng.choices(lines, k=9)) for _ in range(40)]
    out = line_dedup.drop_repeated_lines(as_docs(spark, texts)).collect()
    plain = plain_line_dedup(dict(enumerate(texts)))
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out} == plain
    assert sum(v[2] for v in plain.values()) > 20


# Near-duplicates


def near_texts():
    base = prose(1, 150)
    texts = [edited(base, n, n % 14) for n in range(160)]  # near and not so near copies of one text
    chain = [prose(2, 60).split(" ")]
    for n in range(8):  # each a near copy of the one before only
        step = list(chain[-1])
        step[5 * n : 5 * n + 2] = [f"y{n}a", f"y{n}b"]
        chain.append(step)
    texts += [" ".join(c) for c in chain]
    texts += [prose(n, 20) for n in range(10, 40)] + [prose(10, 20).upper(), "one", "ONE", "one two", "", "   ", None]
    random.Random(3).shuffle(texts)
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    texts = near_texts()
    found = {r.doc_id: r for r in near_dup.near_duplicates(as_docs(spark, texts), words=size).collect()}
    plain = groups(dict(enumerate(texts)), size)
    assert {i: r.component_id for i, r in found.items()} == plain
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(shingles(t, size)) for i, t in enumerate(texts)}


def test_a_lower_threshold_is_refused(spark):
    with pytest.raises(ValueError):
        near_dup.near_duplicates(as_docs(spark, ["a"]), percent=70)


def test_sketches_fill_every_place_and_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 5000).astype(np.uint64)
    sets = [pool[:1], pool[:7], pool[:800], pool[200:1000], pool[:5000], pool[:7]]
    rows = near_dup.sketches(sets)
    assert (rows != np.uint64(2**64 - 1)).all()
    assert (rows[1] == rows[5]).all()
    assert abs((rows[2] == rows[3]).mean() - 600 / 1000) < 0.15
    alone = [near_dup.sketches([s])[0] for s in sets]
    assert all((a == b).all() for a, b in zip(rows, alone))


def test_components_of_chains_stars_and_rings(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    links += [(7, None), (300, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[n] for n in range(41)} == {0}
    assert {found[n] for n in range(100, 140)} == {100} and {found[n] for n in range(200, 203)} == {200}
    assert found[300] == 300


# Passages


def leak_case():
    items = {n: prose(100 + n, 12 + 4 * n) for n in range(8)}
    items |= {8: prose(150, 6), 9: prose(151, 5), 10: "again " * 20 + prose(152, 6)}
    docs = []
    for n, text in items.items():
        words = text.split(" ")
        docs += [
            f"{prose(n, 30)} {text} {prose(n + 50, 30)}",
            text.upper().replace(" ", " \n"),
            f"{prose(n, 7)} {' '.join(words[1:])} zz",  # one word off at the edge
            f"{prose(n, 7)} {' '.join(words[: len(words) // 2])} inserted {' '.join(words[len(words) // 2 :])}",
            " ".join(words[: len(words) // 2]),
            f"{text} and {edited(text, n, 1)}",
        ]
    return docs + [prose(n, 60) for n in range(300, 320)] + ["again " * 50], items


def test_passages(spark):
    texts, items = leak_case()
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = decontaminate.find_passages(as_docs(spark, texts), bench).collect()
    plain = passages(dict(enumerate(texts)), items)
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(plain)
    assert len(plain) > 30
    for r in found:
        window = words_of(texts[r.doc_id])[r.start_word :]
        assert set(window[:9]) & set(words_of(items[r.item_id]))


def moved_case():
    """Items whose parts stand in another order, inside longer documents."""
    items = {n: prose(400 + n, 40 + 25 * n) for n in range(6)} | {6: "over again " * 8 + prose(410, 60)}
    docs = []
    for n, text in items.items():
        words = text.split(" ")
        for cut in (4, 3, 2):
            at = len(words) // cut
            for parts in ((words[at:], words[:at]), (words[at : 2 * at], words[:at], words[2 * at :])):
                docs.append(f"{prose(500 + n, 31 + cut)} {' '.join(sum(parts, []))} {prose(600 + n, 40)}")
                docs.append(f"{prose(700 + n, 90)} {edited(' '.join(sum(parts, [])), n, 1)}")
        docs.append(f"{text} {prose(800 + n, 20)} {' '.join(words[20:] + words[:20])}")
    return docs, items


def test_passages_with_parts_moved(spark):
    texts, items = moved_case()
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = decontaminate.find_passages(as_docs(spark, texts), bench).collect()
    plain = passages(dict(enumerate(texts)), items)
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(plain)
    assert len(plain) > 30


# Packing


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [prose(n, 40 * (n % 9) + n) for n in range(60)] + [prose(3, 6_000), "", None, "a <|endoftext|> b", "naïve 😀\x85x"]
    path = packing.production_tokenizer()
    own = Tokenizer.from_file(path)
    ids = [[*own.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    rows = packing.pack(as_docs(spark, texts), path, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) <= packing.CAPACITY
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert sum((r.ids for r in pieces), []) == ids[doc]
        assert all(r.length == packing.CAPACITY for r in pieces[1:])
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:n]) for n in range(len(pieces))]
    assert set(by_doc) == set(range(len(texts)))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:n]) for n in range(len(pieces))]
        assert sum(r.length for r in pieces) <= packing.CAPACITY
    assert len(by_sequence) <= -(-sum(map(len, ids)) // packing.CAPACITY) + 1


@pytest.mark.parametrize("capacity", [7, 100, 2048, 2500])
def test_plans_place_every_piece_once_and_pack_tightly(capacity):
    rng = random.Random(capacity)
    histogram = {}
    for _ in range(3_000):
        length = min(capacity, max(1, int(rng.lognormvariate(0, 0.8) * capacity / 4)))
        histogram[length] = histogram.get(length, 0) + rng.randint(1, 30)
    plan = packing.plan_packing(histogram, capacity)
    room = {}
    for length, count in histogram.items():
        own = sorted((i for i in plan.intervals if i.length == length), key=lambda i: i.lo)
        assert [i.lo for i in own] == [0, *[i.hi for i in own[:-1]]] and own[-1].hi == count
    for i in plan.intervals:
        for sequence in range(i.sequence, i.sequence + i.hi - i.lo):
            room.setdefault(sequence, []).append((i.offset, i.length))
    assert set(room) == set(range(plan.sequences))
    for pieces in room.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert plan.sequences <= 1.01 * sum(n * c for n, c in histogram.items()) / capacity + 1


def test_nonnegative_least_squares():
    rng = np.random.default_rng(2)
    matrix = rng.random((30, 12))
    exact = np.maximum(rng.normal(size=12), 0)
    assert packing.nonnegative_least_squares(matrix, matrix @ exact) == pytest.approx(exact, abs=1e-5)
    found = packing.nonnegative_least_squares(matrix, -np.ones(30))
    assert (found == 0).all()


# Personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    def passes(kind, found):
        digits = [int(c) for c in found if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, *m.span()) for k, rx in BASE.items() for m in re.finditer(rx, text) if passes(k, m[0])]


def test_base_spans(spark):
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (017) 555-7713", "+12", "é", "@", "..", "\n", " ", "0000255.1.2.3", "9807915762804490"]
    texts = ["".join(rng.choices(parts, k=12)) for _ in range(300)]
    for row in pii.personal_data(as_docs(spark, texts)).collect():
        base = [(s.kind, s.start, s.end) for s in row.pii if s.kind in BASE]
        assert base == plain_base(texts[row.doc_id])


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    plain = {s[0]: s[3] for s in pii.find_spans("DE89 3704 0044 0532 0130 00 or 123-45-6789")}
    near = {s[0]: s[3] for s in pii.find_spans("IBAN DE89 3704 0044 0532 0130 00, social security 123-45-6789")}
    assert plain == {"iban": 0.7} and near["iban"] == 1.0 and near["identity"] == pytest.approx(0.7)
    long = "a." * 200_000 + "1" * 200_000
    assert pii.find_spans(long + " x@y.z")[0][0] == "email"


# Quality


def plain_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[n : n + 3]) for n in range(len(words) - 2)]
    inside = {n + k for n, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    again = sum(1 for n, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r") and x in lines[:n])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def test_counts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices(["a ", "b ", "c ", "é ", "\n", "\t", "# ", "a b c ", "\x1c", "<|>"], k=rng.randint(0, 40)))
        assert quality_rules.text_counts(text)[:5] == plain_counts(text)


def test_learned_rules_find_the_planted_thresholds(spark):
    rng = np.random.default_rng(3)
    data = {"x": rng.random(900), "y": rng.random(900)}
    bad = (data["x"] > 0.8) | ((data["x"] < 0.3) & (data["y"] > 0.6))
    rules = quality_rules.learn_rules(data, bad)
    frame = spark.createDataFrame(list(zip(*(v.tolist() for v in data.values()))), "x double, y double")
    judged = frame.select("x", "y", quality_rules.decision(rules, {"x": F.col("x"), "y": F.col("y")}).alias("kept"))
    wrong = sum(r.kept == ((r.x > 0.8) or (r.x < 0.3 and r.y > 0.6)) for r in judged.collect())
    assert rules and wrong <= 27


def test_labelled_junk_goes_and_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, quality_rules.fit_rules(docs, labels)).join(labels, "doc_id")
    rows = judged.where("not base_failed").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality]
    junk = [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.05 * len(junk)


# Language


def plain_phrases(text, sample):
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_are_the_longest_matches():
    sample = langid.normalised(prose(1, 300))
    samples = langid.Samples("".join(sorted(set(sample) - {" "})), (("a", sample),))
    texts = [langid.normalised(prose(n, 60))[: langid.PIECE] for n in range(20)]
    codes = [langid.class_codes(t, langid.letter_classes(samples.letters)) for t in texts]
    found = langid.count_phrases(codes, langid.phrase_tables(samples), len(samples.letters) + 2)[:, 0]
    assert found.tolist() == [plain_phrases(t, sample) for t in texts]


def scripts():
    """Samples of three languages of many letters and of one with few, and a generator of texts in each."""
    rng = random.Random(1)
    alphabets = [[chr(0x4E00 + 6_000 * n + k) for k in range(2_000)] for n in range(3)]
    words = [["".join(rng.choices(letters, k=rng.randint(2, 3))) for _ in range(1_500)] for letters in alphabets]
    texts = lambda n, rng, size: "".join(rng.choices(words[n], k=size))[:size]
    learned = [(f"l{n}", texts(n, random.Random(n), 12_000)) for n in range(3)] + [("lz", prose(1, 500))]
    return learned, texts


def test_scripts_of_many_letters(spark):
    learned, texts = scripts()
    rows = [(n, text[k : k + 2_000], lang, "s", 1) for n in range(9) for lang, text in learned for k in range(0, 12_000, 2_000)]
    samples = langid.fit_languages(spark.createDataFrame(rows, DOCS))
    rng = random.Random(7)
    asked = [(f"l{n}", texts(n, rng, 10)) for n in range(3) for _ in range(40)]
    found = langid.predict([t for _, t in asked], samples)
    assert sum(f[0] != lang for f, (lang, _) in zip(found, asked)) == 0


def test_phrases_of_rarer_and_unknown_letters():
    sample = langid.normalised(scripts()[0][0][1][:6_000] + " " + prose(2, 100))
    samples = langid.Samples("".join(sorted(set(sample) - {" "})), (("a", sample), ("b", prose(1, 50))))
    texts = [sample[n : n + 90] + sample[2 * n : 2 * n + 60] + "\u03b1" * (n % 3) + sample[n : n + 9] for n in range(0, 800, 50)]
    codes = [langid.class_codes(t.strip(), langid.letter_classes(samples.letters)) for t in texts]
    found = langid.count_phrases(codes, langid.phrase_tables(samples), len(samples.letters) + 2)
    assert found.tolist() == [[plain_phrases(t.strip(), s) for _, s in samples.texts] for t in texts]


@pytest.mark.parametrize("group", [4, 4096])
def test_phrases_go_on_from_piece_to_piece(monkeypatch, group):
    monkeypatch.setattr(langid, "PIECES", group, raising=False)
    sample = langid.normalised(prose(1, 300)) + " " + "a" * 700
    samples = langid.Samples("".join(sorted(set(sample) - {" "})), (("a", sample), ("b", prose(2, 90))))
    texts = [prose(n, 90 * n + 1) for n in range(1, 9)] + [sample[5:], "", "a" * 3_000, sample + "zq" * 300 + sample]
    codes = [langid.class_codes(t, langid.letter_classes(samples.letters)) for t in texts]
    found = langid.count_phrases(codes, langid.phrase_tables(samples), len(samples.letters) + 2)
    assert found.tolist() == [[max(1, plain_phrases(t, s)) for _, s in samples.texts] for t in texts]


def test_a_language_of_long_texts_only_is_learned(spark):
    long = {lang: prose(seed, 9_000) for lang, seed in (("xx", 5), ("yy", 6))}
    rows = [(n, t, lang, "s", 1) for n in range(3) for lang, t in long.items()] + doc_rows([prose(n, 40) for n in range(9)], "zz")
    samples = langid.fit_languages(spark.createDataFrame(rows, DOCS))
    assert [lang for lang, _ in samples.texts] == ["xx", "yy", "zz"]
    assert all(long[lang].startswith(t[:1_000]) for lang, t in samples.texts if lang in long)


def test_many_languages_stay_within_the_budget(spark):
    rows = [(n, prose(n, 3_000), f"l{n % 60}", "s", 1) for n in range(240)]
    samples = langid.fit_languages(spark.createDataFrame(rows, DOCS))
    assert len(samples.texts) == 60 and sum(len(t) for _, t in samples.texts) <= langid.TOTAL_CHARS


def test_language_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = langid.identify(docs, langid.fit_languages(docs)).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    rows = found.where("held_out and n_chars > 100").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = {r.doc_id for r in found.where("held_out").collect()}
    assert held == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}


# Archives and pages


def test_archives_come_back_whole(spark):
    rows = [(n, f"http://h{n}.org/p?q#f", f"<p>{prose(n % 4, 200)}\r\n\r\nWARC/1.1\r\n é{n % 4}</p>") for n in range(12)]
    path = stage_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), path)
    found = warc.assemble_captures(warc.read_records(spark, path))
    found = found.withColumn("page", warc.metadata_field("page-id").cast("int")).collect()
    assert sorted(r.page for r in found) == list(range(12))
    for r in found:
        payload = rows[r.page][2].encode()
        assert r.target_uri == rows[r.page][1] and r.payload_bytes == len(payload)
        assert r.request.block.startswith(f"GET /p?q HTTP/1.1\r\nHost: h{r.page}.org")
        assert r.record_type == ("response" if r.page >= 8 else "revisit")
        assert (bytes(r.payload) == payload) if r.page >= 8 else r.payload is None


def test_links_stated_by_the_response_count_too(spark):
    schema = ("record_id string, record_type string, concurrent_to array<string>, target_uri string, date string, "
              "payload_bytes bigint, payload_digest string, block string")
    rows = [("r", "response", ["q", "q"], "u", "d", 1, "x", None), ("q", "request", [], "u", "d", None, None, "GET"),
            ("m", "metadata", ["r"], "u", "d", None, None, "a: b"), ("lone", "request", ["none"], "u", "d", None, None, "")]
    (found,) = warc.assemble_captures(spark.createDataFrame(rows, schema)).collect()
    assert found.request.record_id == "q" and [m.block for m in found.metadata] == ["a: b"]


def test_truncated_archive():
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse_records(whole + b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")] == [b"abc"]


PAGE = """<html><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div>
<nav><a href="/">Home</a></nav><div class="post-12"><h2>T&eacute;st &amp; more</h2>
<p>First   para <a href=x>link</a> word<p>Second &#8212; para.<ul><li>one<li>two</ul><div class="ad-box">Buy!</div></div>
<aside>Side</aside><div class="comments"><p>{comments}</p></div><form>Name <input></form><footer>f</footer></body></html>"""


def test_page_text():
    page = html_text.Page(PAGE.format(comments=prose(1, 300)))
    assert page.article(None) == "Tést & more\nFirst para link word\nSecond — para.\none\ntwo"
    assert max(page.votes(), key=page.votes().get) == "html>body>div.post-"


WRAPPERS = ["content-sidebar-wrap", "has-sidebar", "layout no-sidebar", "sidebar", "widget-page menu"]


@pytest.mark.parametrize("name", WRAPPERS)
@pytest.mark.parametrize("inner", ["main", "article", "div class='post'"])
def test_wrappers_with_layout_classes_keep_the_page(name, inner):
    text, more = prose(1, 60), prose(2, 15)
    end = inner.split()[0]
    page = html_text.Page(
        f"<body><div class='sidebar'><p>Side</p></div><div class='{name}'><{inner}><p>{text}</p><div class='related'>"
        f"<article><p>{more}</p></article></div></{end}><div class='comments'><p>{prose(3, 90)}</p></div></div></body>"
    )
    assert page.article(max(page.votes(), key=page.votes().get)) == text


def test_parts_of_the_article_stay():
    page = html_text.Page(
        "<body><header>Site</header><div class='site-header'>Name</div><article><header><h1>Head</h1></header>"
        "<div class='entry-header'>By line</div><pre><code>x <span class='token comment'># why</span></code></pre>"
        "<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> see <svg><g/><text>Fig</text></svg> or <svg/>"
        "<object>the file</object>.</p><div class='ad-box'>Buy</div></article></body>"
    )
    assert page.article(None) == "Head\nBy line\nx # why\nIf x=2 see Fig or the file."


def test_the_path_of_the_host_wins(spark):
    usual = "<body><div class='main-text'><p>{0}</p></div><div class='extra'><p>{1}</p></div></body>"
    pages = [(n, "http://h.org/x", usual.format(prose(n, 50), prose(n + 90, 5))) for n in range(5)]
    pages.append((9, "http://h.org/y", usual.format("few words", prose(77, 60))))
    pages.append((10, "http://h.org/z", "<body><article>other layout</article></body>"))
    rows = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract(rows).collect()}
    assert found[9] == "few words" and found[10] == "other layout"
    assert all(found[n] == prose(n, 50) for n in range(5))


def test_url_rules(spark):
    rules = [("b.org", "/x", "block"), ("a.b.org", "/", "allow"), ("b.org", "/xy/z", "allow"), ("b.org", "/xy/z", "block"),
             ("B.ORG", "", "block"), (None, "/", "block")]
    urls = ["http://a.b.org/xy/z", "http://q.b.org/xyz", "http://b.org/q", "http://a.b.org/q", "http://bb.org/x", "ftp://B.org/xy/zz?u"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(
        pages, spark.createDataFrame(rules, url_filter.RULES_SCHEMA)).collect()}
    assert found == {0: ("b.org/xy/z", "block"), 1: ("b.org/x", "block"), 2: ("b.org", "block"),
                     3: ("a.b.org/", "allow"), 4: (None, "allow"), 5: ("b.org/xy/z", "block")}
