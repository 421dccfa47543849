"""A Merkle manifest of a dataset: content-addressed records, proofs by descent, and their check.

A row's leaf is the digest of its columns. The leaves of a group, in the order of their ids, are put together three
by three until one node is left, the group's root; the roots of the groups, in the order of the groups, likewise
give the root of the dataset.

The tree is stored as records from a digest to its children. A record covers ``LEVELS`` levels, so it holds at most
81 children with the levels between, and a tree of n leaves takes log81(n) rounds, each with a shuffle of a 81st of
the rows before. Places within a group come from a range partition, so no task sees a whole group.

Requests descend from the root: at each level the digit of the leaf's place to base three picks a child, and the
children that are not picked join the path. Requests that share the beginning of their way go it as one, so a record
is met once for each row that holds it, the root once in all. At the leaves the segments of a path are
reversed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.llm.places import GROUP_ROWS, PLACE, same, with_places
from comanda.staging import stage

FANOUT, LEVELS = 3, 4
SEGMENT = FANOUT**LEVELS

# The one tree over the roots of all groups.
_TOP = "_top"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*columns: Column) -> Column:
    """The digest of a row: each value as its number of UTF-8 bytes, a colon and itself, null as a dash."""
    texts = [c.cast("string") for c in columns]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*[F.coalesce(s, F.lit("-")) for s in sized])


def fold(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and the siblings on its path, from the leaf upwards, give."""
    path = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.aggregate(path, leaf, lambda node, level: digest(level["left"], node, level["right"]))


def proof_digest(left: Column, right: Column) -> Column:
    """The digest of all siblings of a path from the leaf upwards, each level from left to right."""
    return digest(F.array_join(F.transform(F.arrays_zip(left.alias("a"), right.alias("b")), lambda s: F.concat(s["a"], s["b"])), ""))


def put_together(digests: list[str], levels: int) -> list[list[str]]:
    """The digests and the levels above them, the lowest first."""
    found = [digests]
    for _ in range(levels):
        low = found[-1]
        runs = ("".join(low[at : at + FANOUT]) for at in range(0, len(low), FANOUT))
        found.append([hashlib.sha256(run.encode()).hexdigest() for run in runs])
    return found


def unselected(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """Siblings on the left and on the right of the way down to a place, from the top; ``levels`` from the bottom."""
    left, right = [], []
    for height in range(len(levels) - 1, -1, -1):
        at = place // FANOUT**height
        run = at - at % FANOUT
        left.append("".join(levels[height][run:at]))
        right.append("".join(levels[height][at + 1 : run + FANOUT]))
    return left, right


def _height(rows: Column) -> Column:
    """Levels above ``rows`` leaves: the least h with 3^h at least that."""
    return sum((rows > FANOUT**h).cast("int") for h in range(39))


def _levels_of(leaves: int, round_: int) -> int:
    """Levels that a segment of a tree of so many leaves covers in a round."""
    height = 0
    while FANOUT**height < leaves:
        height += 1
    return max(0, min(LEVELS, height - LEVELS * round_))


@dataclass(frozen=True)
class _Tree:
    """Trees of many groups: bottom segments with their leaves, records of the rounds above, and the roots."""

    bottom: DataFrame
    records: list[DataFrame]
    roots: DataFrame


def _record_rows(segments: DataFrame, group_type: str, round_: int) -> DataFrame:
    """Group, size of the tree, place of the segment, its digest and the levels below it, from the bottom."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                own = put_together([n["digest"] for n in row["nodes"]], _levels_of(row[GROUP_ROWS], round_))
                yield row["_tree"], row[GROUP_ROWS], row["_segment"], own[-1][0], own[:-1]

        return work

    schema = f"_tree {group_type}, {GROUP_ROWS} bigint, _segment bigint, digest string, levels array<array<string>>"
    return map_rows(segments, schema, start)


def _grow(leaves: DataFrame, label: str) -> _Tree:
    """Trees over leaves with ``_tree``, ``_group_rows``, ``_place``, ``digest`` and ``carried``."""
    kind = leaves.schema["_tree"].dataType.simpleString()
    segment = F.floor(F.col(PLACE) / SEGMENT).alias("_segment")

    def segments(nodes: DataFrame, *more: str) -> DataFrame:
        member = F.struct(PLACE, "digest", *more)
        return nodes.groupBy("_tree", GROUP_ROWS, segment).agg(F.array_sort(F.collect_list(member)).alias("nodes"))

    bottom = stage(segments(leaves, "carried"), f"{label}-leaves").df
    most = bottom.agg(F.max(GROUP_ROWS)).first()[0] or 0
    records, roots, round_ = [], None, 0
    given = bottom.select("_tree", GROUP_ROWS, "_segment", F.transform("nodes", lambda n: n.dropFields("carried")).alias("nodes"))
    while True:
        made = stage(_record_rows(given, kind, round_), f"{label}-records").df
        records.append(made)
        done = _height(F.col(GROUP_ROWS)) <= LEVELS * (round_ + 1)
        found = made.where(done).select("_tree", F.col("digest").alias("root"))
        roots = found if roots is None else roots.unionByName(found)
        if not _levels_of(most, round_ + 1):
            return _Tree(bottom, records, roots)
        nodes = made.where(~done).select("_tree", GROUP_ROWS, F.col("_segment").alias(PLACE), "digest")
        given, round_ = segments(nodes), round_ + 1


def _descend(tree: _Tree, requests: DataFrame, carried: str) -> DataFrame:
    """Follow requests (``_tree``, ``digest`` of its root, ``left`` and ``right`` so far) down to all leaves.

    Gives ``carried`` of each leaf, its digest, that of its root, and its path from the top.
    """
    path = "left array<string>, right array<string>"
    kind = requests.schema["_tree"].dataType.simpleString()

    def inner() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                for at, child in enumerate(row["levels"][0]):
                    left, right = unselected(row["levels"], at)
                    place = row["_segment"] * SEGMENT + at
                    yield row["_tree"], row["_root"], place, child, row["left"] + left, row["right"] + right

        return work

    def leaves() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                for at, node in enumerate(row["nodes"]):
                    left, right = unselected(row["levels"], at)
                    yield node["carried"], node["digest"], row["_root"], row["left"] + left, row["right"] + right

        return work

    height = _height(F.col(GROUP_ROWS))
    frontier = None
    for round_ in range(len(tree.records) - 1, -1, -1):
        stored = tree.records[round_]
        # Trees whose root lies in this round begin here; a lone leaf is a record without levels.
        top = height <= LEVELS * (round_ + 1)
        first = stored.where(top & (height > LEVELS * round_) if round_ else top)
        begun = requests.join(
            first.select(F.col("_tree").alias("_of"), "_segment"), F.col("_tree").eqNullSafe(F.col("_of"))
        ).select("_tree", F.col("digest").alias("_root"), "_segment", "digest", "left", "right")
        frontier = begun if frontier is None else frontier.unionByName(begun)
        # Records by content: equal subtrees are one record.
        unique = stored.groupBy(F.col("digest").alias("_digest")).agg(F.first("levels").alias("levels"))
        met = frontier.join(unique, F.col("digest") == F.col("_digest"))
        if round_:
            schema = f"_tree {kind}, _root string, _segment bigint, digest string, {path}"
            frontier = stage(map_rows(met, schema, inner), "way-down").df
    named = met.select(F.col("_tree").alias("_of"), F.col("_segment").alias("_at"), "_root", "levels", "left", "right")
    ends = tree.bottom.join(named, same([F.col("_tree"), F.col("_segment")], [F.col("_of"), F.col("_at")]))
    schema = f"carried {carried}, digest string, root string, {path}"
    return map_rows(ends.select("nodes", "_root", "levels", "left", "right"), schema, leaves, chunk=16)


def manifest(
    docs: DataFrame,
    leaf: Column,
    id_col: str = "doc_id",
    group_col: str = "source",
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per row: its id and group, ``leaf``, ``subroot``, ``root`` and its path ``left`` and ``right``.

    ``leaf`` is the digest of a row (``leaf_digest``). ``left`` and ``right`` hold the siblings of each level from
    the leaf to the root of the dataset, put together, empty where there is none. ``carry`` columns of the input
    come along.

    Leaves of a group stand by id, null first; rows of one id stand by their leaf. A null group is a group, the
    first one. Groups stand by the bytes of their text. Equal rows are leaves of their own. Null or empty texts
    matter to the given leaf only. A lone leaf is its own root and has an empty path. An empty table gives an empty
    table. Other columns are not read, so their names cannot clash.
    """
    carried = F.struct(F.col(id_col).alias("id"), F.col(group_col).alias("tree"), *carry).alias("carried")
    thin = stage(docs.select(F.col(group_col).alias("_tree"), F.col(id_col).alias("_id"), leaf.alias("digest"), carried), "leaves")
    groups = _grow(with_places(thin, ["_tree"], ["_id", "digest"]).drop("_id"), "groups")
    subroots = stage(groups.roots.select(F.col("_tree").alias("_group"), F.col("root").alias("digest")), "subroots")
    one = subroots.with_df(subroots.df.withColumn("_tree", F.lit(_TOP)))
    top = _grow(
        with_places(one, ["_tree"], ["_group"]).withColumn("carried", F.struct("_group")).drop("_group"), "subroots"
    )
    nothing = F.array().cast("array<string>")
    asked = top.roots.select("_tree", F.col("root").alias("digest"), nothing.alias("left"), nothing.alias("right"))
    kind = thin.df.schema["_tree"].dataType.simpleString()
    ways = _descend(top, asked, f"struct<_group:{kind}>")
    ways = stage(ways.select(F.col("carried._group").alias("_tree"), "digest", "left", "right"), "group-paths").df
    found = _descend(groups, ways.select("_tree", "digest", "left", "right"), thin.df.schema["carried"].dataType.simpleString())
    root = top.roots.agg(F.first("root")).scalar()
    extra = [f.name for f in thin.df.schema["carried"].dataType.fields][2:]
    return found.select(
        F.col("carried.id").alias(id_col),
        F.col("carried.tree").alias(group_col),
        F.col("digest").alias("leaf"),
        F.col("root").alias("subroot"),
        root.alias("root"),
        F.reverse("left").alias("left"),
        F.reverse("right").alias("right"),
        *[F.col(f"carried.{name}").alias(name) for name in extra],
    )
