"""Best-fit packing of tokenised documents by patterns of lengths.

Documents are tokenised where they lie and cut into pieces of at most ``capacity`` tokens. Only the histogram of
piece lengths (at most ``capacity`` rows) reaches the driver. There, patterns of up to three lengths that fill a
sequence are enumerated on a grid, non-negative least squares finds how often to use each, the counts are
rounded, and best fit places what is left, first into gaps. The outcome is a table of intervals: the pieces of
one length with ranks from ``lo`` on go to consecutive sequences at one offset. Its size depends on the number of
lengths, not of documents. Ranks within a length are counted per task and then offset, so no task and no group
holds all pieces of a length.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.staging import stage

CAPACITY = 2048
END_OF_TEXT = 0
GRID = 256  # steps of the length grid for the patterns
TINY = 8  # grid steps up to which lengths are left for the gaps
MAX_STEPS = 600  # of the least-squares fit


def production_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text by the tokenizer file at ``path``, special strings included.

    The file's vocabulary and merges make a byte-pair encoder of ``tiktoken``, which gives the ids of
    ``tokenizers`` for such a file at four times the speed; a test compares the two.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    spec = json.loads(open(path, encoding="utf-8").read())
    special = {token["content"]: token["id"] for token in spec["added_tokens"]}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def piece_bounds(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be shorter than ``capacity``."""
    first = tokens % capacity or capacity
    starts = [0, *range(first, tokens, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def tokenised_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Pieces of every document with their rank among the task's pieces of that length."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)

        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                ids = np.append(encode(row["text"] or ""), np.uint32(END_OF_TEXT)).astype("<u4")
                for piece, (at, length) in enumerate(piece_bounds(len(ids), capacity)):
                    own = ids[at : at + length]
                    made = (row["doc_id"], piece, at, length, zlib.crc32(own.tobytes()), task, seen[length])
                    seen[length] += 1
                    yield (*made, own.tolist()) if with_ids else made

        return work

    kind_of_id = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind_of_id}, piece int, start bigint, length bigint, ids_crc32 bigint, _task int, _rank bigint"
    )
    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        schema + (", ids array<bigint>" if with_ids else ""),
        start,
    )


def patterns_on_grid(present: list[int], grid: int) -> list[tuple[int, ...]]:
    """Up to three grid lengths, largest first, that fill a sequence exactly."""
    have = set(present)
    found: list[tuple[int, ...]] = [(grid,)] if grid in have else []
    for a in present:
        if grid - a in have and a >= grid - a:
            found.append((a, grid - a))
        found += [(a, b, grid - a - b) for b in present if b <= a and 0 < grid - a - b <= b and grid - a - b in have]
    return found


def nonnegative_least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The active-set method: let in the column with the steepest descent, solve, step back to stay at or above 0."""
    columns = matrix.shape[1]
    x, inside = np.zeros(columns), np.zeros(columns, bool)
    slope = matrix.T @ target
    tolerance = 1e-9 * max(1.0, float(np.abs(slope).max(initial=0)))
    for _ in range(MAX_STEPS):
        outside = np.where(inside, -np.inf, slope)
        if inside.all() or outside.max() <= tolerance:
            break
        inside[outside.argmax()] = True
        while True:
            chosen = np.flatnonzero(inside)
            part = matrix[:, chosen]
            gram = part.T @ part
            solved = np.linalg.solve(gram + 1e-9 * np.eye(len(chosen)), part.T @ target)
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            down = solved <= 0
            now = x[chosen]
            step = (now[down] / np.maximum(now[down] - solved[down], 1e-300)).min()
            moved = now + step * (solved - now)
            x[:] = 0
            x[chosen] = np.maximum(moved, 0)
            inside[chosen[(moved <= 1e-12) & down]] = False
            if not inside.any():
                break
        slope = matrix.T @ (target - matrix @ x)
    return x


@dataclass(frozen=True)
class Interval:
    """Pieces of ``length`` with ranks lo to hi - 1 go to sequences from ``sequence`` on, at ``offset``."""

    length: int
    lo: int
    hi: int
    sequence: int
    offset: int


class Plan:
    """Places counted pieces; ``gaps`` keeps runs of sequences by the room that they have left."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(histogram)
        self.used = dict.fromkeys(histogram, 0)
        self.sequences = 0
        self.intervals: list[Interval] = []
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # room -> runs of (first sequence, count)
        self.rooms: list[int] = []

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        lo = self.used[length]
        self.intervals.append(Interval(length, lo, lo + count, sequence, offset))
        self.used[length] += count
        self.left[length] -= count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def add_gap(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if room not in self.gaps:
                self.gaps[room] = []
                bisect.insort(self.rooms, room)
            self.gaps[room].append((sequence, count))

    def take_gap(self, length: int, count: int) -> tuple[int, int, int] | None:
        """(room, first sequence, count) of the tightest sequences that hold ``length``, at most ``count``."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        sequence, there = self.gaps[room].pop()
        taken = min(count, there)
        if taken < there:
            self.gaps[room].append((sequence + taken, there - taken))
        elif not self.gaps[room]:
            del self.gaps[room]
            self.rooms.pop(at)
        return room, sequence, taken

    def use_pattern(self, bins: list[list[int]], repeats: int, most_waste: int) -> None:
        """``repeats`` sequences with one piece of each bin, a bin being the lengths nearest to one grid step.

        Of the lengths that a bin still has, those that fill a sequence best are taken for as long as they last;
        the pattern ends when nothing fills it to within ``most_waste`` tokens.
        """
        while repeats:
            best = self.best_lengths(bins)
            if not best or sum(best) < self.capacity - most_waste:
                return
            run = min(repeats, *(self.left[n] // best.count(n) for n in best))
            sequence, offset = self.open(run), 0
            for length in best:
                self.place(length, run, sequence, offset)
                offset += length
            self.add_gap(self.capacity - offset, sequence, run)
            repeats -= run

    def best_lengths(self, bins: list[list[int]]) -> list[int]:
        """One length of each bin with the largest sum up to the capacity; empty if there is none."""
        best: list[int] = []
        for chosen in product(*([n for n in b if self.left[n]] for b in bins)):
            total = sum(chosen)
            if sum(best) < total <= self.capacity and all(self.left[n] >= chosen.count(n) for n in chosen):
                best = list(chosen)
                if total == self.capacity:
                    break
        return best

    def best_fit(self) -> None:
        """All pieces left, longest first, each into the tightest room."""
        for length in sorted(self.left, reverse=True):
            while self.left[length]:
                gap = self.take_gap(length, self.left[length])
                if gap:
                    room, sequence, taken = gap
                    self.place(length, taken, sequence, self.capacity - room)
                    self.add_gap(room - length, sequence, taken)
                    continue
                count, each = self.left[length], self.capacity // length
                opened = max(1, count // each)
                each = min(each, count)
                sequence = self.open(opened)
                for slot in range(each):
                    self.place(length, opened, sequence, slot * length)
                self.add_gap(self.capacity - each * length, sequence, opened)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Intervals for a histogram of lengths from 1 to ``capacity``."""
    plan = Plan(histogram, capacity)
    step = max(1, capacity // GRID)
    grid = capacity // step
    bins: dict[int, list[int]] = {}
    for length in sorted(histogram, reverse=True):
        bins.setdefault((length + step // 2) // step, []).append(length)
    wanted = [b for b in sorted(bins) if TINY < b <= grid]
    patterns = patterns_on_grid(wanted, grid)
    if patterns:
        row = {b: n for n, b in enumerate(wanted)}
        matrix = np.zeros((len(wanted), len(patterns)))
        for n, pattern in enumerate(patterns):
            for b in pattern:
                matrix[row[b], n] += 1
        counts = np.array([sum(histogram[n] for n in bins[b]) for b in wanted], float)
        repeats = nonnegative_least_squares(matrix, counts)
        for n in np.argsort(-repeats, kind="stable"):
            if (times := int(repeats[n] + 0.5)) > 0:
                plan.use_pattern([bins[b] for b in patterns[n]], times, step)
    plan.best_fit()
    return plan


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Every text is tokenised whole and ended by id 0; ``with_ids`` adds the ids of each piece. Null and empty
    texts are the end id alone. Rows that repeat an id, or have none, are packed each for itself; other columns
    are not read. An empty table gives an empty table.
    """
    pieces = stage(tokenised_pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "pieces").df
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = plan_packing({row["length"]: row["count"] for row in counted}, capacity)
    intervals = pieces.sparkSession.createDataFrame(
        [(i.length, i.lo, i.hi, i.sequence, i.offset) for i in plan.intervals],
        "_length bigint, _lo bigint, _hi bigint, _sequence bigint, offset bigint",
    )
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        pieces.groupBy("length", "_task")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    )
    ranked = pieces.join(firsts, ["length", "_task"]).withColumn("_place", F.col("_first") + F.col("_rank"))
    # The intervals depend on the number of lengths alone: broadcasting them is bounded by ``capacity``.
    placed = ranked.join(
        F.broadcast(intervals),
        (F.col("length") == F.col("_length")) & (F.col("_place") >= F.col("_lo")) & (F.col("_place") < F.col("_hi")),
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_sequence") + F.col("_place") - F.col("_lo")).alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )
