"""Near-duplicates by fast similarity sketching, banding and exact verification.

A document is the set of its word shingles, as 64-bit hashes. Sets that are equal become one class first. A class
is sketched into ``COORDINATES`` places: in each round every shingle is hashed to one place and a value, and the
smallest value of the earliest round that reaches a place fills it; in the second half of the rounds round t + i
sends every shingle to place i, so all places are full after at most twice as many rounds as there are places,
and after about one for sets larger than the sketch. Two sets agree in a place with the probability of their
similarity.

Classes that agree in all places of a band share a bucket. Each bucket links its members to its smallest one, so a
bucket of n gives n - 1 pairs. Pairs are confirmed on full sets and joined to components. Where a bucket still
holds several components, the members outside the largest one are compared with the whole bucket, in blocks of
bounded size: a pair is looked at in the first band that it shares, by its sizes, its sketches and then by finer
sketches of those documents alone, and what is near the threshold is confirmed on full sets as well. So no link
within a bucket is lost, and no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.llm.components import components, met
from comanda.operators.heavy import PARTS
from comanda.staging import stage

WORDS, PERCENT = 5, 80
# 40 bands of 5 places: a pair at similarity 0.8 shares no band with probability (1 - 0.8^5)^40 = 1.3e-7.
BANDS, ROWS = 40, 5
COORDINATES = BANDS * ROWS
# Bytes of a place in the stored sketch.
PLACE_BYTES = 2
# Agreeing places below which a pair is not confirmed: five standard deviations under the mean at 0.8.
SURE_MATCHES = 132
# Finer sketches have one byte a place, so other values agree by chance in one of 256.
FINE_PLACES = 1200
FINE_MATCHES = int(FINE_PLACES * (0.8 + 0.2 / 256) - 5 * (FINE_PLACES * 0.8 * 0.2) ** 0.5)
BLOCK = 64
# Blocks of one bucket meet in squares of this many by as many, each with a join key of its own.
SIDE = 32

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD1, _ODD2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
# Shingles sketched at a time; each takes some 60 bytes meanwhile.
_TOGETHER = 1 << 18
_WORDS_REMEMBERED = 500_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _ODD1
    x = (x ^ (x >> np.uint64(27))) * _ODD2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, each computed once as long as there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: str, words: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of a shorter text the whole sequence is the one shingle."""
    # bytes split at exactly [\x20\x09-\x0D], and lower() changes A-Z only
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(words, len(found))
    count = len(found) - size + 1
    made = np.full(count, size, np.uint64)
    for place in range(size):
        made = _mixed((made + hashes[place : place + count]) * _STEP)
    return np.unique(made)


def sketches(sets: list[np.ndarray], places: int = COORDINATES, together: int = _TOGETHER) -> np.ndarray:
    """A row of filled places per non-empty set; places hold the round and the value that won.

    Sets are sketched in lots of about ``together`` shingles, so the memory beside the sets does not grow with long texts
    that come together. A set's row does not depend on the lot.
    """
    if not sets:
        return np.empty((0, places), np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    cuts = np.flatnonzero(np.diff((ends - 1) // together)) + 1
    lots = [sets[a:b] for a, b in zip([0, *cuts], [*cuts, len(sets)])]
    return np.concatenate([_sketched(lot, places) for lot in lots])


def _sketched(sets: list[np.ndarray], places: int) -> np.ndarray:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets)
    filled = np.full(len(sets) * places, _EMPTY)
    missing = np.full(len(sets), places)
    for turn in range(2 * places):
        if not len(items):
            break
        drawn = _mixed(items + np.uint64(int(_STEP) * (turn + 1) % 2**64))
        if turn < places:
            place = ((drawn >> np.uint64(40)) * np.uint64(places) >> np.uint64(24)).astype(np.int64)
        else:
            place = turn - places
        at = owner * places + place
        free = filled[at] == _EMPTY
        at = at[free]
        np.minimum.at(filled, at, (drawn[free] & np.uint64(0xFFFFFFFFFF)) | np.uint64(turn << 40))
        missing -= np.bincount(np.unique(at) // places, minlength=len(sets))
        stays = missing[owner] > 0
        if not stays.all():
            owner, items = owner[stays], items[stays]
    return filled.reshape(-1, places)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        known = WordHashes()

        def work(rows: list[dict]) -> Iterable[tuple]:
            sets = [shingle_set(row["text"] or "", words, known) for row in rows]
            full = [s for s in sets if len(s)]
            short = iter(_mixed(sketches(full)).astype("<u2"))
            for row, own in zip(rows, sets):
                if len(own):
                    digest = xxhash.xxh3_128_digest(own.astype("<u8").tobytes())
                    yield row["doc_id"], len(own), digest, next(short).tobytes()
                else:
                    yield row["doc_id"], 0, None, None

        return work

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, f"doc_id {kind_of_id}, n_shingles bigint, set_hash binary, sketch binary", start)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        known = WordHashes()

        def work(rows: list[dict]) -> Iterable[tuple]:
            last, left = None, None
            for row in rows:
                if row["text_a"] != last:
                    last, left = row["text_a"], shingle_set(row["text_a"], words, known)
                right = shingle_set(row["text_b"], words, known)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    yield row["a"], row["b"]

        return work

    kind = pairs.schema["a"].dataType.simpleString()
    of_b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    of_a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    with_texts = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")
    return map_rows(with_texts, f"a {kind}, b {kind}", start).distinct()


def _band_keys(classes: DataFrame) -> DataFrame:
    width = ROWS * PLACE_BYTES
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("sketch"), band * width + 1, F.lit(width))),
    )
    return classes.select("rep", F.posexplode(keys).alias("band", "key"))


def _heavy_buckets(buckets: DataFrame) -> DataFrame:
    """Buckets with a large share of all members, in the form of ``heavy_keys``; at most ``PARTS``."""
    members = buckets.agg(F.sum("n")).first()[0] or 1
    share = F.col("n") * PARTS / F.lit(members)
    heavy = buckets.where(share > 1).select(F.xxhash64("key").alias("_key"), F.ceil(share).cast("int").alias("_salts"))
    return stage(heavy, "heavy-buckets").df


def _of_bucket(members: DataFrame, buckets: DataFrame, heavy: DataFrame) -> DataFrame:
    """Members with the row of their bucket; those of a heavy bucket are dealt out over several tasks."""
    return met(members, buckets.withColumnRenamed("key", "_bucket"), "key", "_bucket", "rep", "inner", heavy).drop("_bucket")


def _fine_sketches(texts: DataFrame, words: int) -> DataFrame:
    """``id``, size of the set and a sketch of many one-byte places."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        known = WordHashes()

        def work(rows: list[dict]) -> Iterable[tuple]:
            sets = [shingle_set(row["text"], words, known) for row in rows]
            rows, sets = zip(*[(r, s) for r, s in zip(rows, sets) if len(s)]) if any(map(len, sets)) else ((), ())
            for row, own, fine in zip(rows, sets, _mixed(sketches(list(sets), FINE_PLACES)).astype(np.uint8)):
                yield row["id"], len(own), fine.tobytes()

        return work

    kind = texts.schema["id"].dataType.simpleString()
    return map_rows(texts, f"id {kind}, size bigint, fine binary", start)


def _compare_in_blocks(loose: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs of a loose member and one of another component in its bucket that may be similar enough.

    A row holds a block of loose members and a block of members, so that few blocks are sent twice. A large bucket is a
    grid of squares (``_down``, ``_across``), so no task has more than one square of it to itself.
    """

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def near(own: dict, band: int, members: list[dict], sketches_: np.ndarray, sizes: np.ndarray) -> Iterable:
            agree = sketches_ == np.frombuffer(own["sketch"], "<u2")
            first = agree.reshape(len(members), BANDS, ROWS).all(axis=2).argmax(axis=1)
            fits = 100 * np.minimum(sizes, own["size"]) >= percent * np.maximum(sizes, own["size"])
            fits &= (first == band) & (agree.sum(axis=1) >= SURE_MATCHES)
            fine = np.frombuffer(own["fine"], np.uint8)
            for at in np.flatnonzero(fits):
                if (np.frombuffer(members[at]["fine"], np.uint8) == fine).sum() >= FINE_MATCHES:
                    yield members[at]

        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                members = row["members"]
                all_places = np.frombuffer(b"".join(m["sketch"] for m in members), "<u2").reshape(len(members), -1)
                sizes = np.array([m["size"] for m in members])
                for own in row["asked"]:
                    for member in near(own, row["band"], members, all_places, sizes):
                        both_loose = member["component"] != row["main"]
                        if member["component"] != own["component"] and not (both_loose and member["rep"] < own["rep"]):
                            yield min(own["rep"], member["rep"]), max(own["rep"], member["rep"])

        return work

    kind = loose.schema["asked"].dataType.elementType["rep"].dataType.simpleString()
    squares = loose.join(blocks, ["key", "_down", "_across"])
    return map_rows(squares, f"a {kind}, b {kind}", start, chunk=4).distinct()


def _remaining_pairs(
    members: DataFrame,
    heavy: DataFrame,
    known: DataFrame,
    classes: DataFrame,
    texts: DataFrame,
    words: int,
    percent: int,
) -> DataFrame | None:
    """Pairs across components in one bucket that pairs with its smallest member did not settle; None if none."""
    several = members.where("n > 2").select("key", "band", "rep").join(known, F.col("rep") == F.col("node"), "left")
    several = several.select("key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    counted = several.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
    mixed = (
        counted.groupBy("key")
        .agg(
            F.max(F.struct("_n", "component"))["component"].alias("main"),
            F.max("_n").alias("_in_main"),
            F.sum("_n").alias("_size"),
            F.count(F.lit(1)).alias("_parts"),
        )
        .where("_parts > 1")
    )
    mixed = stage(mixed.drop("_parts"), "mixed-buckets")
    if not mixed.rows:
        return None
    inside = stage(_of_bucket(several, mixed.df, heavy), "mixed-members").df
    asked = texts.join(inside.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    fine = _fine_sketches(asked, words).select(F.col("id").alias("rep"), "size", "fine")
    sketched = stage(classes.select("rep", "sketch").join(fine, "rep"), "fine-sketches").df
    own = F.struct("rep", "component", "size", "sketch", "fine")

    def in_blocks(rows: DataFrame, name: str, size: Column, others: Column, along: str, over: str, *more: str) -> DataFrame:
        """Blocks of rows, each laid ``along`` one side of its bucket's grid and repeated ``over`` the other."""
        block = F.pmod(F.xxhash64("rep"), F.ceil(size / BLOCK)).alias("_block")
        squares = F.ceil(others / (BLOCK * SIDE)).alias("_squares")
        return (
            rows.select("key", "rep", "component", block, squares, *more)
            .join(sketched, "rep")
            .groupBy("key", "_block", "_squares", *more)
            .agg(F.collect_list(own).alias(name))
            .withColumn(along, F.floor(F.col("_block") / SIDE))
            .withColumn(over, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_squares") - 1)))
            .drop("_block", "_squares")
        )

    loose = inside.where(F.col("component") != F.col("main"))
    n_loose, n_all = F.col("_size") - F.col("_in_main"), F.col("_size")
    asked = in_blocks(loose, "asked", n_loose, n_all, "_down", "_across", "band", "main")
    return _compare_in_blocks(asked, in_blocks(inside, "members", n_all, n_loose, "_across", "_down"), percent)


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 times the size of the intersection of their sets is at least ``percent`` times
    that of the union; the component is the smallest id reachable, and that document is kept.

    Null and empty texts and texts without words have no shingles, are linked with nothing and kept. Rows with
    one id are one document for the links. A null id takes part with equal sets only: it belongs to their
    component, and without one it has a null component and is kept. Other columns are not read. An empty table
    gives an empty table. Below ``percent`` 80 the bands would miss links; such values are refused.
    """
    if percent < PERCENT:
        raise ValueError(f"the bands are laid out for {PERCENT} percent or more")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(_signatures(named, words), "signatures").df
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
    )
    classes = stage(classes, "classes").df
    keys = _band_keys(classes.where(F.col("rep").isNotNull()))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stage(buckets, "buckets").df
    heavy = _heavy_buckets(buckets)
    members = stage(_of_bucket(keys, buckets, heavy), "members").df
    wanted = members.select(F.col("rep").alias("id")).distinct()
    texts = named.where(F.col("text").isNotNull()).withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi")
    texts = stage(texts, "candidate-texts").df
    star = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_confirmed(star, texts, words, percent), "links").df
    known = components(links)
    more = _remaining_pairs(members, heavy, known, classes, texts, words, percent)
    if more is not None:
        found = stage(_confirmed(more, texts, words, percent), "more-links")
        if found.rows:
            known = components(links.unionByName(found.df))
    placed = (
        signed.select("doc_id", "n_shingles", "set_hash")
        .join(classes.select(F.col("set_hash").alias("_set"), "rep"), F.col("set_hash") == F.col("_set"), "left")
        .join(known, F.col("rep") == F.col("node"), "left")
    )
    component = F.coalesce("component", "rep", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
