"""Conversations, Merkle manifest, fingerprints and fingerprint blocks against plain Python."""

import heapq
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from comanda.llm import conversations, decontaminate, html_text, merkle, pii, vantage, warc
from comanda.llm.places import with_places
from comanda.staging import stage, stage_path
from tests.llm.data import SPACE, edited, prose, sha256, words_of

# Places


def test_places_in_a_group_of_many_partitions(spark):
    rows = [(None if n % 7 == 0 else "big" if n % 3 else f"g{n}", n * 7919 % 1000) for n in range(1000)]
    staged = stage(spark.createDataFrame(rows, "g string, n bigint"), "rows")
    found = with_places(staged, ["g"], ["n"], rows_per_part=40).collect()
    by_group = {}
    for g, n in rows:
        by_group.setdefault(g, []).append(n)
    assert {(r.g, r.n, r._place, r._group_rows) for r in found} == {
        (g, n, place, len(ns)) for g, ns in by_group.items() for place, n in enumerate(sorted(ns))
    }


# Conversations


def cheapest(rows):
    """Faults, cost, audit and repaired rows, by the cheapest way through (rows read, last role)."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        again = (role, text) in seen
        faults.append("blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return faults, cost, audit, list(out)
        role = "assistant" if last == "u" else "user"
        steps = [(2, "I", at, role[0], ((role, ""),))]
        if at < len(rows):
            _, own, text = rows[at]
            steps.append((3, "D", at + 1, last, ()))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                if own[:1] == role[0] or (own[:1] == "s" and last == ""):
                    steps.append((more, "K", at + 1, own[:1], ((own, text),)))
                steps.append((2 + more, "R", at + 1, role[0], ((role, text),)))
        for price, edit, to, then, made in steps:
            heapq.heappush(heap, (cost + price, audit + edit, to, then, out + made))


def broken_conversations():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "unicorn", ""]
    texts = ["Yes.", "No!", "cut", " \n", "", None, "Why?", "é?\t", "x\x85"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 11)):
            text = rng.choice(texts) if rng.random() < 0.4 else prose(rng.randrange(40), 3) + rng.choice([".", "", "!"])
            rows.append((conv, None if rng.random() < 0.05 else turn * 10 + rng.randint(0, 9), rng.choice(roles), text))
    # A conversation over many blocks, and one without an id.
    rows += [(500, n, rng.choice(["user", "assistant", "system"]), f"{n % 250}." if n % 9 else "cut") for n in range(700)]
    rows += [(None, 1, "user", "Hm?"), (None, None, "assistant", "Ah.")]
    return rows


def test_repair(spark):
    rows = broken_conversations()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame = frame.withColumns({n: F.lit("clash") for n in ("_conv", "_place", "_text", "cost", "position", "edit", "_at")})
    report, repaired = conversations.repair(frame)
    shas = {r.conv_id: r.repaired_sha256 for r in conversations.conversation_digests(repaired).collect()}
    out = {}
    for r in sorted(repaired.collect(), key=lambda r: r.position):
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    by_conv = {}
    for conv, turn, role, text in rows:
        row = (turn, " " if role is None else role, " " if text is None else text)
        by_conv.setdefault(conv, []).append(row)
    found = report.collect()
    assert {r.conv_id for r in found} == set(by_conv) and len(found) == len(by_conv)
    for r in found:
        own = sorted(by_conv[r.conv_id], key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        faults, cost, audit, kept = cheapest(own)
        turns = [t for t, *_ in own if t is not None]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert (r.blank, r.duplicate, r.truncated) == tuple(map(faults.count, ("blank", "duplicate", "truncated")))
        assert r.illegal == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        assert (r.cost, r.audit) == (cost, audit)
        assert out.get(r.conv_id, []) == kept
        assert shas.get(r.conv_id, sha256("")) == sha256("\n".join(f"{a}:{b}" for a, b in kept))


@pytest.mark.parametrize("rows", [0, 1])
def test_small_conversations(spark, rows):
    frame = spark.createDataFrame([(1, None, "system", "Be brief.")][:rows], "conv_id bigint, turn bigint, role string, text string")
    report, repaired = conversations.repair(frame)
    assert [(r.gaps, r.cost, r.audit) for r in report.collect()] == [(0, 3, "D")] * rows
    assert repaired.count() == 0 and conversations.conversation_digests(repaired).count() == 0


def test_blocks_and_full_tables_agree():
    rng = random.Random(8)
    for _ in range(40):
        codes = "".join(rng.choices("suaoSUAO1234", k=rng.randint(2, 24)))
        cells = [conversations._row_cell(c) for c in codes]
        at = rng.randint(1, len(codes) - 1)
        parts = [conversations.parse_cells(cells[:at]), conversations.parse_cells(cells[at:])]
        assert conversations._halved(parts) == conversations.parse_cells(cells)


# Merkle


def plain_manifest(rows):
    """leaf index -> (leaf, subroot, root, siblings from the leaf upwards)."""

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for n, place in enumerate(at):
                run = place - place % 3
                paths[n].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 3])))
                at[n] = place // 3
            nodes = [sha256("".join(nodes[n : n + 3])) for n in range(0, len(nodes), 3)]
        return nodes[0], paths

    groups = {}
    for doc, source, leaf in rows:
        groups.setdefault(source, []).append((doc is not None, doc or 0, leaf, doc))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, tops = tree([made[s][0] for s in order])
    return {
        (x[3], s, x[2]): (made[s][0], root, path + top)
        for s, top in zip(order, tops)
        for x, path in zip(sorted(groups[s], key=lambda x: x[:3]), made[s][1])
    }


def test_manifest(spark):
    sizes = {"big": 300, "a": 81, "b": 82, "c": 1, None: 4, "É": 3, "Z": 27, "": 2}
    rows = [(n * 31 % 1009, source, f"text {n % 50}\n{source}") for source, size in sizes.items() for n in range(size)]
    rows += [(None, "a", None), (7, "twice", "x"), (7, "twice", "y"), (8, "same", "z"), (8, "same", "z")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    frame = frame.withColumns({n: F.lit("clash") for n in ("_tree", "_id", "digest", "carried", "root", "left", "levels")})
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    found = merkle.manifest(frame, leaf, carry=[F.octet_length("text").alias("bytes")])
    found = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("left"), F.col("right")))
    found = found.withColumn("altered", merkle.fold(F.sha2(F.lit("other"), 256), F.col("left"), F.col("right")))
    found = found.withColumn("proof", merkle.proof_digest(F.col("left"), F.col("right"))).collect()
    sized = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    plain = plain_manifest([(d, s, sha256(sized(d) + sized(s) + sized(t))) for d, s, t in rows])
    assert len(found) == len(rows)
    for r in found:
        subroot, root, path = plain[r.doc_id, r.source, r.leaf]
        if r.source != "same":
            assert list(zip(r.left, r.right)) == path
        assert (r.subroot, r.root, r.folded) == (subroot, root, root) and r.altered != root
        assert r.proof == sha256("".join(a + b for a, b in zip(r.left, r.right)))


@pytest.mark.parametrize("rows", [0, 1])
def test_small_manifests(spark, rows):
    frame = spark.createDataFrame([(1, None, "x")][:rows], "doc_id bigint, source string, text string")
    found = merkle.manifest(frame, merkle.leaf_digest(F.col("text"))).collect()
    assert [(r.leaf, r.subroot, r.root, r.left, r.right) for r in found] == [(sha256("1:x"),) * 3 + ([], [])] * rows


# Fingerprints and vantage-point trees


def plain_print(text):
    words = words_of(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[n : n + 4]).encode(), 42) for n in range(max(len(words) - 3, 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [root(n) for n in range(len(prints))]


def near_copies():
    base = prose(1, 200)
    texts = [edited(base, n, n % 5) for n in range(120)] + [prose(n, 30) for n in range(100, 140)]
    return texts + [base.upper(), "one", "ONE", "one two", "", None, " \n", "é\x85 x", *[prose(101, 30)] * 5]


@pytest.mark.parametrize("shard, piece", [(8, 50_000), (512, 7)])
def test_vantage_dedup(spark, monkeypatch, shard, piece):
    monkeypatch.setattr(vantage, "PIECE", piece)
    texts = near_copies()
    assert [vantage.fingerprint(t) for t in texts] == [plain_print(t) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    frame = frame.withColumns({n: F.lit("clash") for n in ("fp", "rep", "node", "component", "leaf", "part")})
    found = {r.doc_id: r for r in vantage.near_fingerprints(frame, shard=shard, sample=64).collect()}
    prints = [plain_print(t) for t in texts]
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == dict(enumerate(prints))
    assert {i: r.component_id for i, r in found.items()} == dict(enumerate(plain_components(prints)))


def test_crowded_shards_lose_no_pair(spark, monkeypatch):
    """A cluster in one shard, cut into blocks, and links between many shards."""
    monkeypatch.setattr(vantage, "BLOCK", 16)
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(300)}
    prints |= {p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for p in list(prints)}
    prints |= {5 ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(200)}
    prints = sorted(prints)
    signed = [(int(np.uint64(p).view(np.int64)), n) for n, p in enumerate(prints)]
    classes = stage(spark.createDataFrame(signed, "fp bigint, rep bigint"), "classes")
    forest = vantage.fit_forest(classes, sample=200, shard=20)
    assert forest[0].depth > 4
    links = vantage._links(vantage._blocked(vantage._in_shards(classes.df, forest))).collect()
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= 4 for r in links)
    parent = list(range(len(prints)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for r in links:
        low, high = sorted((root(r.a), root(r.b)))
        parent[high] = low
    assert [root(n) for n in range(len(prints))] == plain_components(prints)


def test_pruned_branches_hold_no_neighbour():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**63, 2000).astype(np.uint64)
    near = prints ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    for part in range(vantage.PARTS):
        tree = vantage.fit_tree(prints[:500], part, 9)
        who, leaves = tree.visits(prints)
        visited = set(zip(who.tolist(), leaves.tolist()))
        assert all((n, leaf) in visited for n, leaf in enumerate(tree.homes(near).tolist()))
        assert all((n, leaf) in visited for n, leaf in enumerate(tree.homes(prints).tolist()))


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert vantage.near_fingerprints(empty).count() == 0
    lone = spark.createDataFrame([(None, "a b"), (3, "a b"), (None, "c")], "doc_id bigint, text string")
    assert sorted(str(r.component_id) for r in vantage.near_fingerprints(lone).collect()) == ["3", "3", "None"]


# Fingerprint blocks of decontamination, credentials, archives


def test_every_fingerprint_within_the_radius_is_met(spark):
    rng = random.Random(9)
    items = [rng.getrandbits(64) for _ in range(30)]
    windows = [p ^ sum(1 << b for b in rng.sample(range(64), n)) for p in items for n in (0, 1, 9, 23, 24, 25, 30)]
    signed = lambda values: [(n, 7, int(np.uint64(v).view(np.int64))) for n, v in enumerate(values)]
    left = spark.createDataFrame(signed(windows), "w bigint, _size int, _print bigint")
    right = spark.createDataFrame(signed(items), "i bigint, _size int, _print bigint")
    found = [(r.w, r._ofi) for r in decontaminate.near_items(left, right).collect()]
    wanted = {
        (n, m) for n, a in enumerate(windows) for m, b in enumerate(items) if (a ^ b).bit_count() <= decontaminate.RADIUS
    }
    assert len(found) == len(set(found)) and set(found) == wanted


def test_fingerprints_of_shingles(spark):
    rng = random.Random(6)
    hashes = {n: [rng.getrandbits(64) for _ in range(n + 1)] for n in range(12)}
    rows = [(n, int(np.uint64(h).view(np.int64))) for n, hs in hashes.items() for h in hs]
    found = {r.n: r._print % 2**64 for r in decontaminate._prints(spark.createDataFrame(rows, "n int, _hash bigint"), "n").collect()}
    majority = lambda hs: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert found == {n: majority(hs) for n, hs in hashes.items()}


def test_templated_items_do_not_meet_templated_documents(spark):
    template = prose(900, 11)
    items = spark.createDataFrame([(n, f"{template} {prose(n, 4)}") for n in range(60)], "item_id bigint, text string")
    texts = [f"{prose(1000 + n, 20)} {template} {prose(2000 + n, 20)}" for n in range(80)] + [f"{template} {prose(7, 4)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [tuple(r)[:2] for r in decontaminate.find_passages(docs, items).collect()] == [(80, 7)]


@pytest.mark.parametrize(
    "text, found",
    [
        ('token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71"', ["abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71"]),
        ("PASSWORD: aK3/9zLq+0xPv7Tn2bWm==", ["aK3/9zLq+0xPv7Tn2bWm=="]),
        ("commit abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71", []),
        ("secret " + "a1" * 20, []),
        ("the token of understandingcounterrevolutionary", []),
        ("token " + "9" * 30, []),
    ],
)
def test_credentials(text, found):
    assert [text[s:e] for kind, s, e, _ in pii.find_spans(text) if kind == "credential"] == found


def test_archives_bound_their_files_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 300_000)
    pages = [(n, f"http://h/{n}", None if size is None else "x" * size) for n, size in enumerate([100] * 9 + [60_000] * 9 + [400_000] * 3 + [None])]
    path = stage_path(spark, "warc-bytes")
    warc.write_archives(spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1), path)
    records = warc.read_records(spark, path)
    assert warc.assemble_captures(records).count() == len(pages)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    held = [sum(len(block) for _, block in warc.parse_records(bytes(f.content))) for f in files]
    assert len(held) >= 5 and max(held) < 420_000


def test_archives_are_read_once(spark):
    path = stage_path(spark, "warc-once")
    warc.write_archives(spark.createDataFrame([(1, "http://h/", "x")], "page_id bigint, url string, html string"), path)
    found = warc.assemble_captures(warc.read_records(spark, path, with_payload=False))
    assert "binaryFile" not in found._jdf.queryExecution().toString() and found.count() == 1


# Main text: pages written around a known article


def written_page(rng, host, n):
    """(html, article text): a layout of the host around blocks of an article; the blocks are the truth."""
    blocks = [prose(rng.randrange(10**6), rng.randint(12, 60)) + " é & <b>." for _ in range(rng.randint(2, 6))]
    marked = [b.replace("&", "&amp;").replace("<b>", "&lt;b&gt;").replace(" ", rng.choice([" ", "  ", "\n "])) for b in blocks]
    marked = [f"<em>{b}</em>" if rng.random() < 0.2 else b for b in marked]
    tags = [rng.choice(["p", "p", "h2", "blockquote"]) for _ in blocks]
    inside = "".join(f"<{t}>{b}</{t}>" for t, b in zip(tags, marked))
    links = "".join(f'<li><a href="/{k}">{prose(k, 3)}</a></li>' for k in range(5))
    around = {
        0: ('<article class="post">', "</article>"),
        1: (f'<div id="page-{n}"><div class="entry content">', "</div></div>"),
        2: ("<main><section>", "</section></main>"),
    }[host % 3]
    html = (
        f"<html><head><title>{prose(n, 3)}</title><style>p {{}}</style></head><body><nav><ul>{links}</ul></nav>"
        f'<header>{prose(n + 1, 4)}</header><div class="sidebar">{links}</div>{around[0]}{inside}'
        f'<div class="ad">{prose(n + 2, 20)}</div><script>var a = "<p>no</p>";</script>{around[1]}'
        f'<div class="comments"><p>{prose(n + 3, 60)}</p></div><footer>{prose(n + 4, 5)}</footer></body></html>'
    )
    return html, "\n".join(blocks)


@pytest.fixture(scope="module")
def written(spark):
    rng = random.Random(12)
    made = {}
    for n in range(120):
        host = 0 if n % 3 == 0 else rng.randrange(1, 9)  # a third of the pages on one host
        made[n] = (f"http://h{host}.example/{n}", *written_page(rng, host, n))
    rows = [(n, url, html) for n, (url, html, _) in made.items()]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string"), {n: m[2] for n, m in made.items()}


@pytest.mark.parametrize("limit", [html_text.BROADCAST_BYTES, 0])
def test_articles_of_written_pages(written, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", limit)
    pages, articles = written
    found = html_text.extract(pages.repartition(3)).collect()
    assert {r.page_id: r.text for r in found} == articles
    assert all(r.n_chars == len(r.text) for r in found) and len(found) == len(articles)


def test_a_tie_of_votes_goes_to_the_longer_path(spark):
    def page(order):
        parts = {"a": f"<div class='one'><p>{prose(1, 40)}</p></div>", "b": f"<div class='twofold'><p>{prose(2, 40)}</p></div>"}
        return "<body>" + "".join(parts[o] for o in order) + "</body>"

    votes = [html_text.Page(page(o)).votes() for o in ("ab", "ba")]
    rows = [(n, "http://t/", page(o)) for n, o in enumerate(("ab", "ba"))]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    total = {path: sum(v.get(path, 0) for v in votes) for path in set().union(*votes)}
    best = max(total, key=lambda p: (round(total[p], 6), len(p), p))
    assert {r.text for r in found} == {html_text.Page(page("ab")).article(best)} and len(found) == 2
