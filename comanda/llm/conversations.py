"""Repair of conversations by weighted interval parsing.

Each row of a conversation, in the order of its turns, is kept, given another role or deleted, and rows can be put
in anywhere; the repaired roles must read as an optional system row and then user and assistant in turn, or nothing. The grammar of
these role sequences is in Chomsky normal form: a symbol stands for a sequence of one kind, told by its first and
last role, and a rule puts two symbols together (``_PAIRS``). A cell of the parse table holds for a span of rows and
each symbol the least (cost, audit); the audit has a letter for every edit, and the ASCII-least of the cheapest is
taken. No cheapest audit of a cell begins another one, as both have a letter for every row and equal costs, so least
parts give the least whole. Cells are closed under insertions on both sides.

Spans are parsed from short to long. Blocks of ``BLOCK`` rows are parsed in full, each span by all its splits;
equal blocks are parsed once a task. Longer spans are put together from ``BLOCK`` blocks each, round by round; every
part of a sentence has a symbol, so the splits between blocks lose nothing. A conversation that holds a
third of all rows is so parsed by many tasks, and its rows lie in many partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import OUT_ROWS, SPACE, map_rows
from comanda.llm.places import GROUP_ROWS, PLACE, same, with_places
from comanda.staging import stage

BLOCK, BLOCK_BITS = 16, 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
ENDS = "[.!?]"

# Symbols: no row, a system row alone, and sequences by their first and last role.
NONE, SYSTEM = "-", "s"
_SYMBOLS = (NONE, SYSTEM, "su", "sa", "uu", "ua", "au", "aa")
_SENTENCES = (NONE, "ua", "sa")

# A row for the parser: the role's initial (o for any other), as it is, truncated, or to be deleted.
_SOUND, _CUT, _BAD = "suao", "SUAO", "1234"

Cell = dict[str, tuple[int, str]]


def _pairs() -> dict[tuple[str, str], str]:
    """The binary rules: which symbols may follow each other, and the symbol of both."""
    rules = {}
    for left in _SYMBOLS:
        for right in _SYMBOLS:
            if NONE in (left, right):
                rules[left, right] = left if right == NONE else right
            elif right[0] != "s" and left[-1] + right[0] in ("su", "ua", "au"):
                rules[left, right] = left[0] + right[-1]
    return rules


_PAIRS = _pairs()
_PUT_IN: Cell = {"uu": (COSTS[INSERT], INSERT), "aa": (COSTS[INSERT], INSERT)}


def _take(cell: Cell, symbol: str, found: tuple[int, str]) -> bool:
    if symbol in cell and cell[symbol] <= found:
        return False
    cell[symbol] = found
    return True


def _put_together(left: Cell, right: Cell, into: Cell) -> None:
    for a, (cost_a, audit_a) in left.items():
        for b, (cost_b, audit_b) in right.items():
            symbol = _PAIRS.get((a, b))
            if symbol and (symbol not in into or cost_a + cost_b <= into[symbol][0]):
                _take(into, symbol, (cost_a + cost_b, audit_a + audit_b))


def _closed(cell: Cell) -> Cell:
    """The cell with rows put in on both sides, as often as that makes something cheaper."""
    while True:
        wider = dict(cell)
        _put_together(cell, _PUT_IN, wider)
        _put_together(_PUT_IN, cell, wider)
        if wider == cell:
            return cell
        cell = wider


@cache
def _row_cell(code: str) -> Cell:
    cell: Cell = {NONE: (COSTS[DELETE], DELETE)}
    if code not in _BAD:
        more = TRUNCATED_COST if code in _CUT else 0
        own = {"s": SYSTEM, "u": "uu", "a": "aa"}.get(code.lower())
        if own:
            _take(cell, own, (COSTS[KEEP] + more, KEEP))
        for symbol in ("uu", "aa"):
            _take(cell, symbol, (COSTS[REROLE] + more, REROLE))
    return _closed(cell)


def parse_cells(cells: list[Cell]) -> Cell:
    """The cell of all rows: every span from the shortest to the longest, each by all its splits."""
    table = {(at, at + 1): cell for at, cell in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for begin in range(len(cells) - length + 1):
            end, cell = begin + length, {}
            for middle in range(begin + 1, end):
                _put_together(table[begin, middle], table[middle, end], cell)
            table[begin, end] = _closed(cell)
    return table[0, len(cells)]


@lru_cache(maxsize=50_000)
def parse_block(codes: str) -> Cell:
    return parse_cells([_row_cell(code) for code in codes])


def _halved(cells: list[Cell]) -> Cell:
    """The cell of all spans together, put together in pairs."""
    while len(cells) > 1:
        longer = []
        for at in range(0, len(cells) - 1, 2):
            cell: Cell = {}
            _put_together(cells[at], cells[at + 1], cell)
            longer.append(_closed(cell))
        cells = longer + cells[len(longer) * 2 :]
    return cells[0]


def _illegal(codes: str) -> int:
    roles = _initials(codes)
    return sum(roles[at : at + 2] not in ("su", "ua", "au") for at in range(len(roles) - 1))


def _initials(codes: str) -> str:
    return codes.translate(str.maketrans(_CUT + _BAD, _SOUND * 2))


_SPAN = "illegal bigint, first string, last string, costs array<bigint>, audits array<string>"


def _span(cell: Cell, illegal: int, first: str, last: str) -> tuple:
    found = [cell.get(symbol, (None, None)) for symbol in _SYMBOLS]
    return illegal, first, last, [c for c, _ in found], [a for _, a in found]


def _cell(span: dict) -> Cell:
    return {s: (c, a) for s, c, a in zip(_SYMBOLS, span["costs"], span["audits"]) if c is not None}


def _first_spans() -> Callable[[list[dict]], Iterable[tuple]]:
    def work(rows: list[dict]) -> Iterable[tuple]:
        for row in rows:
            codes = "".join(r["_code"] for r in row["rows"])
            roles = _initials(codes)
            yield row["_conv"], row[GROUP_ROWS], row["_at"], *_span(parse_block(codes), _illegal(codes), roles[0], roles[-1])

    return work


def _longer_spans() -> Callable[[list[dict]], Iterable[tuple]]:
    def work(rows: list[dict]) -> Iterable[tuple]:
        for row in rows:
            parts = [r["span"] for r in row["rows"]]
            borders = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:]))
            illegal = borders + sum(p["illegal"] for p in parts)
            whole = _halved([_cell(p) for p in parts])
            yield row["_conv"], row[GROUP_ROWS], row["_at"], *_span(whole, illegal, parts[0]["first"], parts[-1]["last"])

    return work


def _best() -> Callable[[list[dict]], Iterable[tuple]]:
    """The cheapest sentence of each conversation."""

    def work(rows: list[dict]) -> Iterable[tuple]:
        for row in rows:
            cell = _cell(row)
            (cost, audit), symbol = min((cell[s], s) for s in _SENTENCES if s in cell)
            yield row["_conv"], row["illegal"], cost, audit, symbol == "sa"

    return work


def _edits() -> Callable[[list[dict]], Iterable[tuple]]:
    """The rows that stay or are put in: their position, the place of the row behind them, and a new role."""

    def work(rows: list[dict]) -> Iterable[tuple]:
        for row in rows:
            place, position, lead = 0, 0, int(row["system"])
            for edit in row["audit"]:
                if edit != DELETE:
                    role = ("user", "assistant")[(position - lead) % 2] if edit != KEEP else None
                    yield row["_conv"], position, None if edit == INSERT else place, role, edit
                    position += 1
                place += edit != INSERT

    return work


def _with_codes(rows: DataFrame) -> DataFrame:
    """``_fault`` of each placed row and its ``_code`` for the parser."""
    bare = F.btrim("_text", F.lit(SPACE))
    rows = rows.withColumns({"_h1": F.xxhash64("_text"), "_h2": F.xxhash64(F.lit(1), "_text")})
    keys = ["_conv", "_role", "_h1", "_h2"]
    again = rows.groupBy(*keys).agg(F.min(PLACE).alias("_earliest"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = again.select(*[F.col(k).alias(f"_a{k}") for k in keys], "_earliest")
    met = same([F.col(k) for k in keys], [F.col(f"_a{k}") for k in keys])
    fault = (
        F.when(bare == "", "blank")
        .when(F.col(PLACE) > F.col("_earliest"), "duplicate")
        .when(~F.right(bare, F.lit(1)).rlike(ENDS), "truncated")
    )
    initial = F.left("_role", F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), F.instr(F.lit(_SOUND), initial)).otherwise(len(_SOUND))
    letters = (
        F.when(F.col("_fault").isin("blank", "duplicate"), _BAD).when(F.col("_fault") == "truncated", _CUT).otherwise(_SOUND)
    )
    judged = rows.join(again, met, "left").select("_conv", "_turn", PLACE, GROUP_ROWS, fault.alias("_fault"), kind.alias("_kind"))
    return judged.withColumn("_code", F.substring(letters, F.col("_kind"), F.lit(1)))


def repair(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """A report with one row per conversation, and the repaired rows.

    The report has the id, ``gaps`` (turns that are missing between the least and the greatest), ``blank``, ``duplicate``
    and ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose roles' initials are not su, ua or
    au), ``cost`` and ``audit`` of the cheapest repair. Repaired rows have the id, ``position`` from 0, ``role``,
    ``text`` and ``edit`` (K, R or I).

    A null id is a conversation; a null role or text reads as one space; null turns come first and are left out of
    the gaps. Rows of one turn stand by role and text. A text without another character than white space is blank; a
    row whose role and text came before is a duplicate; a text whose last such character is none of ``.!?`` is
    truncated. An empty table gives empty tables. Other columns are not read. Runs jobs.
    """
    space = F.lit(" ")
    named = rows.select(
        F.col(id_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(role_col, space).alias("_role"),
        F.coalesce(text_col, space).alias("_text"),
    )
    named = stage(named, "conversation-rows")
    placed = stage(with_places(named, ["_conv"], ["_turn", "_role", "_text"]), "placed-rows").df
    coded = stage(_with_codes(placed), "coded-rows").df
    longest = coded.agg(F.max(GROUP_ROWS)).first()[0] or 0

    at = F.shiftright(PLACE, BLOCK_BITS).alias("_at")
    blocks = coded.groupBy("_conv", GROUP_ROWS, at).agg(F.array_sort(F.collect_list(F.struct(PLACE, "_code"))).alias("rows"))
    kind = placed.schema["_conv"].dataType.simpleString()
    schema = f"_conv {kind}, {GROUP_ROWS} bigint, _at bigint, {_SPAN}"
    spans = stage(map_rows(blocks, schema, _first_spans), "spans").df
    reach, whole = BLOCK, []
    while reach < longest:
        whole.append(spans.where(F.col(GROUP_ROWS) <= reach))
        span = F.struct("_at", F.struct("illegal", "first", "last", "costs", "audits").alias("span"))
        longer = spans.where(F.col(GROUP_ROWS) > reach).groupBy(
            "_conv", GROUP_ROWS, F.shiftright("_at", BLOCK_BITS).alias("_next")
        )
        longer = longer.agg(F.array_sort(F.collect_list(span)).alias("rows")).withColumnRenamed("_next", "_at")
        spans = stage(map_rows(longer, schema, _longer_spans), "spans").df
        reach *= BLOCK
    for shorter in whole:
        spans = spans.unionByName(shorter)
    best = map_rows(
        spans.select("_conv", "illegal", "costs", "audits"),
        f"_conv {kind}, illegal bigint, cost bigint, audit string, system boolean",
        _best,
    )
    best = stage(best, "repairs").df

    turns = coded.groupBy("_conv", "_turn").agg(
        *[F.count_if(F.col("_fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    )
    gaps = F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count("_turn"), F.lit(0))
    counts = turns.groupBy(F.col("_conv").alias("_of")).agg(
        gaps.alias("gaps"), *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")]
    )
    report = best.join(counts, F.col("_conv").eqNullSafe(F.col("_of"))).select(
        F.col("_conv").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    edits = map_rows(
        best.select("_conv", "audit", "system"),
        f"_of {kind}, position bigint, _behind bigint, _new string, edit string",
        _edits,
    )
    given = placed.select("_conv", PLACE, "_role", "_text")
    met = same([F.col("_of"), F.col("_behind")], [F.col("_conv"), F.col(PLACE)])
    repaired = edits.join(given, met, "left").select(
        F.col("_of").alias(id_col),
        "position",
        F.coalesce("_new", "_role").alias("role"),
        F.coalesce("_text", F.lit("")).alias("text"),
        "edit",
    )
    return report, repaired


def conversation_digests(repaired: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The id and ``repaired_sha256`` of each conversation: ``role:text`` of its rows, joined by newlines.

    The digest of one text can only be taken from its beginning to its end. Rows are sorted by position and pass one
    at a time, so a task holds no conversation.
    """
    kind = repaired.schema[id_col].dataType
    arrow = pa.schema([("at", pa.string()), ("sha", pa.string())])
    line = F.concat("role", F.lit(":"), "text").alias("line")
    # The id as text, so that it can be compared in Python whatever its type.
    sent = repaired.select(F.col(id_col).cast("string").alias("at"), "position", line)
    sent = sent.repartition("at").sortWithinPartitions("at", "position").select("at", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, digest = None, None
        for batch in batches:
            for at, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or at != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = at, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], schema=arrow)
                done = []
        if digest is not None:
            done.append((now, digest.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], schema=arrow)

    found = sent.mapInArrow(run, "at string, sha string")
    return found.select(F.col("at").cast(kind).alias(id_col), F.col("sha").alias("repaired_sha256"))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults, a twentieth of the rows each, by ``crc32(conv_id:turn) % 20``.

    0 drops a row, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 sets its role to user. A null reads
    as one space. Other columns are dropped.
    """
    space = F.lit(" ")

    def or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    named = rows.select(
        "conv_id",
        "turn",
        or_space("role").alias("role"),
        or_space("text").alias("text"),
        (F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20).alias("_case"),
    )
    text = F.when(F.col("_case") == 1, "").when(F.col("_case") == 2, F.regexp_replace("text", ENDS, ""))
    copies = F.when(F.col("_case") == 3, 2).otherwise(1)
    return named.where("_case <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_case") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")
