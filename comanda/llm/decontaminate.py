"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact weighted shingles.

A window is as long as a benchmark item, in five-word shingles. Windows and items have a 64-bit SimHash each: a bit is
set if over half of their shingles' hashes, repeats included, have it. Two fingerprints are near at ``RADIUS`` or
fewer differing bits. They are cut into ``BLOCKS`` blocks; of two near ones some block differs in ``FLIPS`` bits at
most, so an item laid out under each block's value and that value with one bit turned meets every window near it
(``near_items``). Candidates are pairs of document and item; the exact similarity, below, decides on them.

A window at ``PERCENT`` similarity shares 8/9 of its shingles with the item. Each bit then differs with probability
0.152 at most, 9.7 bits with a deviation of 2.9: ``RADIUS`` is five deviations above that. As the two windows next to the best one
are candidates as well, a passage is missed with a probability below 1e-6, and only at the threshold.

Which windows are laid follows from the same bound, without loss: those that hold so many shingles of any items of their
length. Documents are first chosen by seeds, shared shingles among every third position (for items of at least
``LONG`` shingles; every position counts if there is a shorter item), whose number in such a window is known for
a length. A shingle that many items share, as a template is, adds one hit for each length, not for each item.

Exact similarity: every occurrence of a shingle counts once, as often as the item has it. A shared shingle therefore
counts for one run of window starts: from the first window that reaches it to the last that still holds it and not
yet as many later ones as the item has. Adding up these runs from left to right gives the similarity of every window,
whatever the order of the shingles, and only the shingles that document and item share are looked at.

Only DataFrame functions are used. Documents move once, and only to meet their own seeds; benchmark rows move by
joins whose side Spark picks by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import WORD_GAP, lower_az, row_key, trimmed
from comanda.staging import stage

WORDS, PERCENT = 5, 80
LONG, STRIDE = 6, 3
BITS, RADIUS, BLOCKS = 64, 24, 13
FLIPS = RADIUS // BLOCKS
_BORDERS = [BITS * n // BLOCKS for n in range(BLOCKS + 1)]
# Two counts of 32 bits in a number: bits n and n + 32 of a hash are counted together.
_LANE = 32
_BOTH_LANES = (1 << _LANE) + 1


def _words(text: Column) -> Column:
    """Lower-case words (A-Z); an empty array for null and for text without a word."""
    clean = trimmed(F.coalesce(text, F.lit("")))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(lower_az(clean), WORD_GAP, -1))


def _shingle(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + place) for place in range(WORDS)])


def _hits_needed(width: Column, size: Column) -> Column:
    """Shared shingles of a window of ``width`` and an item of ``size`` at the least similarity."""
    return F.ceil(PERCENT * (width + size) / (100 + PERCENT)).cast("int")


def _prints(shingles: DataFrame, *by: str) -> DataFrame:
    """``_print``, the SimHash of the ``_hash`` values of each group."""
    sums = [
        F.sum(F.shiftrightunsigned("_hash", bit).bitwiseAND(F.lit(_BOTH_LANES))).alias(f"_s{bit}")
        for bit in range(_LANE)
    ]
    counted = shingles.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *sums)
    made = F.lit(0).cast("bigint")
    for bit in range(_LANE):
        low = F.col(f"_s{bit}").bitwiseAND(F.lit((1 << _LANE) - 1))
        high = F.shiftrightunsigned(f"_s{bit}", _LANE)
        value = 1 << (bit + _LANE)
        value -= (value >> (BITS - 1)) << BITS
        made = made.bitwiseOR(F.when(2 * low > F.col("_n"), F.lit(1 << bit)).otherwise(0).cast("bigint"))
        made = made.bitwiseOR(F.when(2 * high > F.col("_n"), F.lit(value)).otherwise(0).cast("bigint"))
    return counted.select(*by, made.alias("_print"))


def _block(number: int) -> tuple[Column, int]:
    """The value of a block of ``_print`` and its number of bits."""
    low, high = _BORDERS[number], _BORDERS[number + 1]
    return F.shiftrightunsigned("_print", low).bitwiseAND(F.lit((1 << (high - low)) - 1)).cast("int"), high - low


def near_items(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``windows`` and of ``items`` whose ``_size`` is equal and ``_print`` near, each pair once.

    All pairs within ``RADIUS`` are found: one of ``BLOCKS`` blocks differs in ``FLIPS`` bits at most, and an item
    is under all such values of each of its blocks. A pair that meets in several blocks counts in the first.
    """
    assert FLIPS == 1
    of_window, of_item = [], []
    for number in range(BLOCKS):
        value, width = _block(number)
        key = lambda v: F.struct(F.lit(number).alias("block"), v.alias("value"))  # noqa: B023, E731
        of_window.append(key(value))
        of_item += [key(value), *[key(value.bitwiseXOR(F.lit(1 << bit))) for bit in range(width)]]
    laid = items.select(*[F.col(c).alias(f"_of{c}") for c in items.columns], F.explode(F.array(*of_item)).alias("_of_key"))
    asked = windows.withColumn("_key", F.explode(F.array(*of_window)))
    met = asked.join(laid, (F.col("_size") == F.col("_of_size")) & (F.col("_key") == F.col("_of_key")))
    apart = F.col("_print").bitwiseXOR(F.col("_of_print"))
    first = F.lit(None).cast("int")
    for number in reversed(range(BLOCKS)):
        low, high = _BORDERS[number], _BORDERS[number + 1]
        inside = F.shiftrightunsigned(apart, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        first = F.when(F.bit_count(inside) <= FLIPS, F.lit(number)).otherwise(first)
    found = met.where((F.bit_count(apart) <= RADIUS) & (F.col("_key.block") == first))
    return found.drop("_key", "_of_key")


def _starts(places: Column, need: Column, width: Column, last: Column) -> Column:
    """Starts of all windows that hold at least ``need`` of the places, which are in order."""

    def of(n: Column) -> Column:
        low = F.greatest(F.get(places, n + need - 1) - width + 1, F.lit(0))
        high = F.least(F.get(places, n), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    enough = F.size(places) >= need
    starts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - need), of)))
    return F.when(enough, starts).otherwise(F.array().cast("array<int>"))


def _seeds_needed(size: Column, stride: Column) -> Column:
    """Seeds that a window of ``size`` shingles holds at least if it is similar enough."""
    tested = F.floor(size / stride)
    return F.greatest(tested - F.floor(size * (100 - PERCENT) / 100), F.lit(1))


def _runs(hits: Column, width: Column, last: Column) -> Column:
    """First and last window start for which each hit counts; ``hits`` are in order of shingle and place."""

    def run(hit: Column, n: Column) -> Column:
        later = F.get(hits, n + hit["times"])
        until = F.when(later["hash"] == hit["hash"], later["at"] - width)
        return F.struct(
            F.greatest(hit["at"] - width + 1, F.lit(0)).alias("first"), F.least(hit["at"], until, last).alias("last")
        )

    return F.filter(F.transform(hits, run), lambda r: r["first"] <= r["last"])


def _best_window(runs: Column) -> Column:
    """The most runs that hold one window start, and the first such start."""
    opened = F.transform(runs, lambda r: F.struct(r["first"].alias("at"), F.lit(1).alias("step")))
    closed = F.transform(runs, lambda r: F.struct((r["last"] + 1).alias("at"), F.lit(-1).alias("step")))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("both"), F.lit(0).alias("at"))

    def move(found: Column, event: Column) -> Column:
        now = found["now"] + event["step"]
        better = now > found["both"]
        return F.struct(
            now.alias("now"),
            F.when(better, now).otherwise(found["both"]).alias("both"),
            F.when(better, event["at"]).otherwise(found["at"]).alias("at"),
        )

    return F.aggregate(F.array_sort(F.concat(opened, closed)), start, move)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item that it holds: ``doc_id``, ``item_id``, ``similarity``, ``start_word``.

    The similarity is that of the best of all windows, its start the first with that similarity, counted in words
    from 0. It is at least 0.8.

    Null and empty texts hold nothing, and items of fewer than five words have no shingle and match nothing. A
    document shorter than an item is one window. Rows of one id are searched each by its own text and reported
    under that id once; so are items that repeat an id. Null ids are reported as null. Other columns are not
    read. Empty tables give an empty table.
    """
    items = benchmark.select(F.col(item_col).alias("_item_id"), _words(F.col(item_text_col)).alias("_w"))
    items = items.where(F.size("_w") >= WORDS)
    positions = F.sequence(F.lit(0), F.size("_w") - WORDS)
    items = items.select(
        "_item_id", F.transform(positions, lambda at: _shingle(F.col("_w"), at)).alias("_item_hashes")
    ).distinct()
    items = items.select(
        "_item_id", row_key(F.col("_item_hashes")).alias("_item"), F.size("_item_hashes").alias("_size"), "_item_hashes"
    )
    items = stage(items, "benchmark-items").df
    stride = items.agg(
        F.coalesce(F.when(F.min("_size") < LONG, F.lit(1)).otherwise(F.lit(STRIDE)), F.lit(STRIDE)).alias("_stride")
    ).scalar()
    offered = items.select("_item_id", "_item", "_size", F.explode("_item_hashes").alias("_hash"))
    offered = offered.groupBy("_item_id", "_item", "_size", "_hash").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    laid = offered.select("_size", "_hash").distinct()

    text = F.col(text_col)
    cut = docs.select(F.col(id_col).alias("_id"), row_key(text).alias("_row"), _words(text).alias("_w"), stride.alias("_stride"))
    cut = cut.where(F.size("_w") >= WORDS)
    tested = F.transform(
        F.sequence(F.lit(0), F.size("_w") - WORDS, F.col("_stride")), lambda at: _shingle(F.col("_w"), at)
    )
    seeds = cut.select("_id", "_row", "_stride", F.posexplode(tested).alias("_n", "_hash"))
    hits = seeds.join(laid, "_hash")
    found = hits.groupBy("_id", "_row", "_size", "_stride").agg(F.count_distinct("_n").alias("_seeds"))
    found = found.where(F.col("_seeds") >= _seeds_needed(F.col("_size"), F.col("_stride")))
    found = found.groupBy(F.col("_id").alias("_of"), F.col("_row").alias("_of_row")).agg(F.collect_set("_size").alias("_sizes"))
    found = stage(found, "seeds").df

    whole = docs.select(F.col(id_col).alias("_id"), row_key(text).alias("_row"), text.alias("_text"))
    met = whole.join(found, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row")))
    met = met.select("_id", "_row", "_sizes", _words(F.col("_text")).alias("_w"))
    places = F.transform(F.sequence(F.lit(0), F.size("_w") - WORDS), lambda at: _shingle(F.col("_w"), at))
    met = stage(met.select("_id", "_row", "_sizes", places.alias("_hashes")), "candidate-documents").df
    asked = met.select("_id", "_row", "_sizes", F.size("_hashes").alias("_all"), F.posexplode("_hashes").alias("_at", "_hash"))
    shared = asked.join(laid, "_hash").where(F.array_contains("_sizes", F.col("_size"))).drop("_sizes")
    shared = stage(shared, "shared-shingles").df

    width = F.least("_size", "_all")
    # A set, as rows may repeat an id with its text.
    spots = shared.groupBy("_id", "_row", "_all", "_size").agg(F.array_sort(F.collect_set("_at")).alias("_places"))
    starts = _starts(F.col("_places"), _hits_needed(width, F.col("_size")), width, F.col("_all") - width)
    spots = spots.select(
        F.col("_id").alias("_of"), F.col("_row").alias("_of_row"), "_size", width.alias("_width"), F.explode(starts).alias("_start")
    )
    windows = met.select("_id", "_row", "_hashes").join(
        spots, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row"))
    )
    windows = windows.select(
        "_id", "_row", "_size", "_start", F.explode(F.slice("_hashes", F.col("_start") + 1, F.col("_width"))).alias("_hash")
    )
    windows = _prints(windows, "_id", "_row", "_size", "_start")
    item_prints = _prints(
        items.select("_item_id", "_item", "_size", F.explode("_item_hashes").alias("_hash")), "_item_id", "_item", "_size"
    )
    near = near_items(windows, item_prints).select(
        F.col("_id").alias("_of"), F.col("_row").alias("_of_row"), "_size", F.col("_of_item_id").alias("_near_id"), F.col("_of_item").alias("_near")
    )
    near = stage(near.distinct(), "near-items").df

    # The hits of each candidate, then only those that the item has.
    held = shared.withColumnRenamed("_size", "_of_size").join(
        near,
        F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row")) & (F.col("_of_size") == F.col("_size")),
    ).select("_id", "_row", "_all", "_at", "_hash", "_near_id", "_near")
    of_items = offered.withColumnRenamed("_hash", "_item_hash")
    both = held.join(
        of_items,
        F.col("_near_id").eqNullSafe(F.col("_item_id")) & (F.col("_near") == F.col("_item")) & (F.col("_hash") == F.col("_item_hash")),
    )
    hit = F.struct(F.col("_hash").alias("hash"), F.col("_at").alias("at"), F.col("_times").alias("times"))
    pairs = both.groupBy("_id", "_row", "_all", "_item_id", "_item", "_size").agg(
        F.array_sort(F.collect_set(hit)).alias("_hits")
    )
    pairs = pairs.withColumn("_window", _best_window(_runs(F.col("_hits"), width, F.col("_all") - width)))
    pairs = pairs.select("_id", "_item_id", "_window.both", "_window.at", (width + F.col("_size")).alias("_sum"))
    pairs = pairs.withColumn("_union", F.col("_sum") - F.col("both"))
    similar = pairs.where(100 * F.col("both") >= PERCENT * F.col("_union"))
    best = F.max(F.struct((F.col("both") / F.col("_union")).alias("s"), (-F.col("at")).alias("at")))
    return (
        similar.groupBy("_id", "_item_id")
        .agg(best.alias("_best"))
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_item_id").alias("item_id"),
            F.col("_best.s").alias("similarity"),
            (-F.col("_best.at")).cast("bigint").alias("start_word"),
        )
    )
