"""Near-duplicates by SimHash fingerprints and vantage-point trees.

A document's fingerprint has a bit for each bit of the 64-bit hashes of its word shingles: set if over half of the
hashes have it. Fingerprints at ``RADIUS`` or fewer differing bits are linked.

The Hamming distance between random fingerprints hardly varies, so a vantage point on all 64 bits would send most
queries both ways. The bits are therefore cut into ``PARTS``: of two linked fingerprints at least one part differs
in ``RADIUS // PARTS`` bits at most. Each part has a tree of its own, whose nodes split fingerprints by the distance of their part to a
vantage point. By the triangle inequality a fingerprint can only have neighbours below the radius of a node if its
own distance is at most the radius plus ``REACH``, and above only if it is more than the radius less ``REACH``; the
other branch is pruned. A leaf is a shard: it holds the fingerprints that live there, and is visited by those from
leaves of smaller numbers that may have neighbours in it (neighbours are so by both sides, so one visit finds a pair). In a
shard all pairs are compared on all 64 bits; a pair belongs to the first part on which it is close.

The vantage points and radii are taken from a bounded sample of fingerprints (``SAMPLE``); deeper nodes, which the
sample cannot fill, draw a point by hashing their number and split at half the bits. That sets the sizes of shards only: every
fingerprint is placed and compared. Shards larger than ``BLOCK`` are cut into blocks, and each pair of blocks is a
task's work, so one crowded shard is compared by many tasks. Pairs leave as a spanning forest of each comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.llm.components import components
from comanda.staging import Staged, stage

WORDS, SEED = 4, 42
BITS, RADIUS = 64, 4
PARTS = 3
REACH = RADIUS // PARTS
SAMPLE = 16_384
SHARD, BLOCK = 512, 2048
# Sample fingerprints that a node needs to choose its vantage point and radius by them.
FITTED = 16
# Shingles hashed at a time, whatever the length of the text.
PIECE = 50_000

_BORDERS = [BITS * n // PARTS for n in range(PARTS + 1)]
MASKS = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(_BORDERS, _BORDERS[1:])]
_BIT_ORDER = np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of a text; zero without words. Fewer words than a shingle has are one shingle."""
    # bytes split at exactly [\x20\x09-\x0D], and lower() changes A-Z only
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    count = max(len(found) - words + 1, 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, PIECE):
        stop = min(at + PIECE, count)
        piece = found[at : stop + words - 1]
        joined = b" ".join(piece)
        ends = np.cumsum(np.fromiter(map(len, piece), np.int64, len(piece)) + 1)
        begins = np.concatenate([[0], ends[: stop - at - 1]]).tolist()
        ends = (ends[min(words, len(piece)) - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends)], np.uint64)
        spread = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += spread.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << _BIT_ORDER[2 * ones > count]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed number."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            found = np.array([fingerprint(row["text"], words) for row in rows], np.uint64).view(np.int64)
            return zip((row["doc_id"] for row in rows), found.tolist())

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(named, f"doc_id {kind}, fp bigint", start)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class VantageTree:
    """A tree over one part of the fingerprints: node n has the children 2n and 2n + 1, all leaves one depth.

    ``points`` and ``radii`` are those of the fitted nodes, by number; the others follow from their number.
    """

    mask: int
    depth: int
    points: np.ndarray
    radii: np.ndarray

    def node(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vantage point and radius of each node; a fingerprint goes below if its distance is at most the radius."""
        known = np.minimum(numbers, len(self.radii) - 1)
        fitted = (numbers < len(self.radii)) & (self.radii[known] >= 0)
        drawn = _mixed(numbers.astype(np.uint64) + np.uint64(self.mask)) & np.uint64(self.mask)
        half = (self.mask.bit_count() - 1) // 2
        return np.where(fitted, self.points[known], drawn), np.where(fitted, self.radii[known], half)

    def homes(self, prints: np.ndarray) -> np.ndarray:
        """The leaf of each fingerprint."""
        own, at = prints & np.uint64(self.mask), np.ones(len(prints), np.int64)
        for _ in range(self.depth):
            points, radii = self.node(at)
            at = 2 * at + (np.bitwise_count(own ^ points) > radii)
        return at

    def visits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which fingerprint (by its place) may have neighbours in which leaf, its own leaf included."""
        own = prints & np.uint64(self.mask)
        who, at = np.arange(len(prints)), np.ones(len(prints), np.int64)
        for _ in range(self.depth):
            points, radii = self.node(at)
            away = np.bitwise_count(own[who] ^ points).astype(np.int64)
            below, above = away - REACH <= radii, away + REACH > radii
            who = np.concatenate([who[below], who[above]])
            at = np.concatenate([2 * at[below], 2 * at[above] + 1])
        return who, at


def fit_tree(sample: np.ndarray, part: int, depth: int) -> VantageTree:
    """Vantage points from the sample, each the point farthest from its node's first one, radii at the median."""
    mask = MASKS[part]
    held = {1: sample & np.uint64(mask)}
    fitted = min(depth, max(0, int(np.log2(max(len(sample), 1) / FITTED)) + 1))
    points, radii = np.zeros(2**fitted, np.uint64), np.full(2**fitted, -1, np.int64)
    for number in range(1, 2**fitted):
        own = held.pop(number, None)
        if own is None or len(own) < FITTED:
            continue
        point = own[np.bitwise_count(own ^ own[0]).argmax()]
        away = np.bitwise_count(own ^ point).astype(np.int64)
        # The split by distance that is most even.
        counts = np.cumsum(np.bincount(away))
        radius = int(np.abs(2 * counts - len(own)).argmin())
        points[number], radii[number] = point, radius
        held[2 * number], held[2 * number + 1] = own[away <= radius], own[away > radius]
    return VantageTree(mask, depth, points, radii)


def fit_forest(classes: Staged, sample: int = SAMPLE, shard: int = SHARD) -> list[VantageTree]:
    """A tree for each part, fitted on at most ``sample`` fingerprints: those with the least hashes."""
    drawn = classes.df.orderBy(F.xxhash64("fp"), "fp").limit(sample).select("fp")
    given = np.array([r.fp for r in drawn.collect()], np.int64).view(np.uint64)
    depth = 0
    while classes.rows > shard * 2**depth:
        depth += 1
    return [fit_tree(given, part, depth) for part in range(PARTS)]


def _in_shards(classes: DataFrame, forest: list[VantageTree]) -> DataFrame:
    """A row for each shard that a fingerprint lives in or visits."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterator[tuple]:
            prints = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
            for part, tree in enumerate(forest):
                homes = tree.homes(prints)
                who, leaves = tree.visits(prints)
                later = leaves >= homes[who]
                for n, leaf in zip(who[later].tolist(), leaves[later].tolist()):
                    yield part, leaf, leaf == homes[n], rows[n]["fp"], rows[n]["rep"]

        return work

    kind = classes.schema["rep"].dataType.simpleString()
    return map_rows(classes, f"part int, leaf bigint, lives boolean, fp bigint, rep {kind}", start)


def _blocked(shards: DataFrame) -> DataFrame:
    """Rows of two blocks to compare: ``members`` live in the shard, ``others`` live there or visit it."""
    sizes = shards.groupBy("part", "leaf").agg(
        F.count_if("lives").alias("_members"), F.count_if(~F.col("lives")).alias("_visitors")
    )
    sizes = sizes.where((F.col("_members") > 1) | ((F.col("_members") == 1) & (F.col("_visitors") > 0)))

    def blocks(rows: str):
        return F.ceil(F.col(rows) / BLOCK)

    own = F.pmod(F.xxhash64("fp"), F.greatest(F.when(F.col("lives"), blocks("_members")).otherwise(blocks("_visitors")), F.lit(1)))
    rows = shards.join(sizes, ["part", "leaf"]).withColumn("_own", own)
    none = F.array().cast("array<struct<a:bigint,b:bigint,left:boolean>>")
    members, visitors = blocks("_members"), blocks("_visitors")

    def cells(first, count, make):
        return F.when(count > 0, F.transform(F.sequence(first, first + count - 1), make)).otherwise(none)

    def cell(a, b, left):
        return F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), F.lit(left).alias("left"))

    zero = F.lit(0).cast("bigint")
    # Blocks of members are numbered from 0 and meet those from their own on; visitors are numbered from -1 down.
    of_member = F.concat(
        cells(F.col("_own"), members - F.col("_own"), lambda b: cell(F.col("_own"), b, True)),
        cells(zero, F.col("_own"), lambda a: cell(a, F.col("_own"), False)),
        cells(zero, visitors, lambda v: cell(F.col("_own"), -1 - v, True)),
    )
    of_visitor = cells(zero, members, lambda a: cell(a, -1 - F.col("_own"), False))
    dealt = rows.select(
        "part", "leaf", "fp", "rep", F.explode(F.when(F.col("lives"), of_member).otherwise(of_visitor)).alias("_cell")
    )
    one = F.struct("fp", "rep")
    return dealt.groupBy("part", "leaf", F.col("_cell.a").alias("a"), F.col("_cell.b").alias("b")).agg(
        F.collect_list(F.when(F.col("_cell.left"), one)).alias("members"),
        F.collect_list(F.when(~F.col("_cell.left"), one)).alias("others"),
    )


def close_pairs(left: np.ndarray, right: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs at ``RADIUS`` or less whose first close part is this one."""
    found_a, found_b = [], []
    step = max(1, 2**17 // max(len(right), 1))
    for at in range(0, len(left), step):
        apart = left[at : at + step, None] ^ right
        a, b = np.nonzero(np.bitwise_count(apart) <= RADIUS)
        apart = apart[a, b]
        mine = np.bitwise_count(apart & np.uint64(MASKS[part])) <= REACH
        for earlier in range(part):
            mine &= np.bitwise_count(apart & np.uint64(MASKS[earlier])) > REACH
        found_a.append(a[mine] + at)
        found_b.append(b[mine])
    return np.concatenate(found_a), np.concatenate(found_b)


def _forest(names: list, a: Iterable[int], b: Iterable[int]) -> Iterator[tuple]:
    """Of the pairs, those that join two of the trees so far."""
    parent = list(range(len(names)))

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for n, m in zip(a, b):
        low, high = root(n), root(m)
        if low != high:
            parent[high] = low
            yield names[n], names[m]


def _links(cells: DataFrame) -> DataFrame:
    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterator[tuple]:
            for row in rows:
                members = row["members"]
                others = members if row["a"] == row["b"] else row["others"]
                left, right = (np.array([m["fp"] for m in side], np.int64).view(np.uint64) for side in (members, others))
                if not len(left) or not len(right):
                    continue
                a, b = close_pairs(left, right, row["part"])
                if row["a"] == row["b"]:
                    once = a < b
                    a, b, names = a[once], b[once], [m["rep"] for m in members]
                else:
                    b, names = b + len(members), [m["rep"] for m in members + others]
                yield from _forest(names, a.tolist(), b.tolist())

        return work

    field = cells.schema["members"].dataType.elementType["rep"].dataType.simpleString()
    return map_rows(cells, f"a {field}, b {field}", start, chunk=4)


def near_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, shard: int = SHARD
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    The component is the smallest id reachable over links at 4 or fewer differing bits. Links between documents of one
    fingerprint follow from it, so a text that a third of all documents hold is one fingerprint in the search.

    Null and empty texts and texts without words have fingerprint zero and are linked like any other. Rows with
    one id are documents of their own with one name. A null id takes part with equal fingerprints only: it belongs to
    their component, and without one it has a null component. Other columns are not read. An empty table
    gives an empty table.
    """
    signed = stage(fingerprints(docs, id_col, text_col), "fingerprints").df
    classes = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    forest = fit_forest(classes, sample, shard)
    named = classes.df.where(F.col("rep").isNotNull())
    shards = stage(_in_shards(named, forest), "shards").df
    links = stage(_links(_blocked(shards)), "close-fingerprints").df
    # Fingerprints of one id are one node, so the links need no more than ids.
    known = components(links.where("a <> b"))
    placed = signed.join(classes.df.select(F.col("fp").alias("_fp"), "rep"), F.col("fp") == F.col("_fp"))
    return placed.join(known, F.col("rep") == F.col("node"), "left").select(
        F.col("doc_id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component", "rep").alias("component_id"),
    )
