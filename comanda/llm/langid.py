"""Language by cross-parsing entropy.

Each language is known by a bounded sample of its text, held as a suffix automaton. An unseen text is parsed from
left to right into the longest phrases that occur in that sample; the fewer phrases it needs, normalised to bits
a character, the closer the language. A language's automaton becomes a dense table from (state, letter) to the next
state with a mark where a phrase ends, and a sorted list of edges for the rarer letters of a large alphabet, so numpy
steps through many pieces of text at a time. Every letter of a sample is told apart.

The fit collects texts of a documented bound, beginnings of longer ones where a language has no other; predictions
read whole texts of every document and nothing but the text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comanda.llm.common import judge_rows, map_rows

# Bounds of the fit: texts per language by hash, none longer than MAX_TEXT_CHARS, joined up to CHARS_PER_LANGUAGE
# or to an equal share of TOTAL_CHARS, which bounds the tables of a worker whatever the number of languages. The
# driver collects at most DRIVER_CHARS, an equal share for each language, and one text more of each.
DOCS_PER_LANGUAGE, MAX_TEXT_CHARS, CHARS_PER_LANGUAGE = 96, 20_000, 48_000
TOTAL_CHARS, DRIVER_CHARS = 240_000, 9_600_000
# Letters of a language with a column in its dense table; the edges of its other letters are looked up.
DENSE_LETTERS = 120
UNDETERMINED = "und"

# Texts are stepped through in pieces of this many characters, so many at a time; phrases go on from piece to piece.
PIECE, PIECES = 512, 4096
PHRASE_END = 1 << 30
SPACE_CLASS = 0


@dataclass(frozen=True)
class Samples:
    """Letters with a class, and (language, normalised sample) by language."""

    letters: str
    texts: tuple[tuple[str, str], ...]


def normalised(text: str) -> str:
    """Lower-case letters with single spaces for all else."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def in_training(doc_id: Column) -> Column:
    """Whether a document may be learned from; never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def fit_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Samples:
    """Samples of every language from documents with a language, a text and an id that training may use.

    At most ``DOCS_PER_LANGUAGE`` texts of a language come to the driver, chosen by hash before the shuffle.
    Whole texts are taken as long as they fit the budget, and the shortest if none does. A language whose texts are
    all longer than the bound, or than its share of the budget, is learned from their beginnings.
    """
    text = F.col(text_col)
    known = docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & in_training(F.col(id_col)))
    languages = max(1, known.select(lang_col).distinct().count())
    budget = max(1, min(CHARS_PER_LANGUAGE, TOTAL_CHARS // languages))
    longest = min(MAX_TEXT_CHARS, budget)
    known = known.select(
        F.col(lang_col).alias("_lang"),
        F.substring(text, 1, longest).alias("_text"),
        (F.char_length(text) > longest).alias("_cut"),
        F.xxhash64(id_col, text_col).alias("_order"),
    )
    by_lang = Window.partitionBy("_lang").orderBy("_cut", "_order", "_text")
    first = known.withColumn("_place", F.row_number().over(by_lang)).where(F.col("_place") <= DOCS_PER_LANGUAGE)
    before = F.sum(F.char_length("_text")).over(
        Window.partitionBy("_lang").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = first.withColumn("_before", F.coalesce(before, F.lit(0)))
    rows = first.where(F.col("_before") < max(1, DRIVER_CHARS // languages)).collect()
    by_language: dict[str, list[str]] = {}
    whole: set[str] = set()
    for row in sorted(rows, key=lambda r: (r["_lang"], r["_place"])):
        lang = row["_lang"]
        if row["_cut"] and lang in whole:
            continue
        if letters := normalised(row["_text"]):
            by_language.setdefault(lang, []).append(letters)
            if not row["_cut"]:
                whole.add(lang)
    texts = {}
    for lang, found in by_language.items():
        parts: list[str] = []
        for letters in found:
            if sum(map(len, parts)) + len(letters) <= budget:
                parts.append(letters)
        texts[lang] = " ".join(parts or [min(found, key=len)])
    letters = set("".join(texts.values())) - {" "}
    return Samples("".join(sorted(letters)), tuple(sorted(texts.items())))


def suffix_automaton(codes: Iterable[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in following[at]:
            following[at][code] = new
            at = link[at]
        if at >= 0:
            other = following[at][code]
            if length[other] == length[at] + 1:
                link[new] = other
            else:
                clone = len(following)
                following.append(dict(following[other]))
                length.append(length[at] + 1)
                link.append(link[other])
                while at >= 0 and following[at].get(code) == other:
                    following[at][code] = clone
                    at = link[at]
                link[other] = link[new] = clone
        last = new
    return following


@lru_cache(maxsize=2)
def letter_classes(letters: str) -> np.ndarray:
    """The class of every code point: 0 no letter, 1 and up the known letters, then one for other letters."""
    classes = np.zeros(0x110000, np.uint32)
    other = len(letters) + 1
    known = {c: n for n, c in enumerate(letters, 1)}
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            classes[point] = known.get(char.lower(), other)
    return classes


@dataclass(frozen=True)
class Phrases:
    """A language's automaton. States are multiplied by the width of a row of ``dense``."""

    columns: np.ndarray  # the column of every letter class
    dense: np.ndarray
    rare: np.ndarray  # the number of every letter class among the rarer letters, 0 for all others
    edges: np.ndarray  # state * rares + number, ascending
    targets: np.ndarray
    restart: np.ndarray  # by number, the state after a rarer letter that ends a phrase
    rares: int

    def step(self, state: np.ndarray, column: np.ndarray, rare: np.ndarray | None) -> np.ndarray:
        """Next states, with a mark where the letter ends the phrase that was open."""
        step = self.dense.take(state + column)
        if rare is not None and (rows := np.flatnonzero(rare)).size:
            number = rare[rows]
            wanted = state[rows].astype(np.int64) * self.rares + number
            at = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            step[rows] = np.where(self.edges[at] == wanted, self.targets[at], self.restart[number] | PHRASE_END)
        return step


@lru_cache(maxsize=2)
def phrase_tables(samples: Samples) -> list[Phrases]:
    classes = {" ": SPACE_CLASS} | {c: n for n, c in enumerate(samples.letters, 1)}
    padding_class = len(samples.letters) + 2
    tables = []
    for _, text in samples.texts:
        common = Counter(text)
        common.pop(" ", None)
        ordered = [classes[c] for c in sorted(common, key=lambda c: (-common[c], c)) if c in classes]
        near, far = ordered[:DENSE_LETTERS], ordered[DENSE_LETTERS:]
        other, padding, width = len(near) + 1, len(near) + 2, len(near) + 3
        columns = np.full(padding_class + 1, other, np.int32)
        columns[SPACE_CLASS], columns[padding_class] = 0, padding
        columns[near] = np.arange(1, other)
        rares = len(far) + 1
        rare = np.zeros(padding_class + 1, np.int32)
        rare[far] = np.arange(1, rares)

        states = suffix_automaton(classes.get(c, padding_class - 1) for c in text)
        dead = len(states) * width  # after a letter that the sample does not have
        start = np.zeros(width, np.int32)
        start[other] = dead
        far_restart = np.zeros(rares, np.int32)
        for letter, to in states[0].items():
            if rare[letter]:
                far_restart[rare[letter]] = to * width
            elif columns[letter] != other:
                start[columns[letter]] = to * width
        dense = np.tile(start | PHRASE_END, (len(states) + 1, 1))
        dense[0, other] = dead
        dense[:, padding] = np.arange(len(states) + 1) * width
        edges = []
        for state, following in enumerate(states):
            for letter, to in following.items():
                if rare[letter]:
                    edges.append((state * width * rares + int(rare[letter]), to * width))
                elif columns[letter] != other:
                    dense[state, columns[letter]] = to * width
        edges.sort()
        found = np.array(edges, np.int64).reshape(-1, 2)
        tables.append(
            Phrases(columns, dense.ravel(), rare, found[:, 0].copy(), found[:, 1].astype(np.int32), far_restart, rares)
        )
    return tables


def class_codes(text: str, classes: np.ndarray) -> np.ndarray:
    """Letter classes of a text with runs of other characters as one space, none at the start."""
    codes = classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    stays = codes != SPACE_CLASS
    stays[1:] |= codes[:-1] != SPACE_CLASS
    return codes[stays]


def _walk(table: Phrases, letters: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Phrases ended in each piece. ``letters`` holds a piece in each column; ``begins`` marks those that begin a text.

    All pieces are first read as if a phrase began with them. Then those after another are read again from the state
    in which that one ended, up to the letter where both readings are in one state, from which they agree. A piece
    whose end has changed by that passes its new end on.
    """
    columns = table.columns[letters]
    rare = table.rare[letters] if table.rares > 1 else [None] * PIECE
    steps = np.empty(columns.shape, np.int32)
    state = np.zeros(columns.shape[1], np.int32)
    for n, (column, far) in enumerate(zip(columns, rare)):
        steps[n] = table.step(state, column, far)
        state = steps[n] & (PHRASE_END - 1)
    inner = np.flatnonzero(~begins)
    entered = np.zeros(columns.shape[1], np.int32)
    while (rows := inner[state[inner - 1] != entered[inner]]).size:
        now = entered[rows] = state[rows - 1]
        for n in range(PIECE):
            step = table.step(now, columns[n, rows], None if rare[n] is None else rare[n][rows])
            now = step & (PHRASE_END - 1)
            parts = now != (steps[n, rows] & (PHRASE_END - 1))
            steps[n, rows] = step
            rows, now = rows[parts], now[parts]
            if not rows.size:
                break
        state[rows] = now
    return (steps >> 30).sum(axis=0, dtype=np.int64)


def count_phrases(texts: list[np.ndarray], tables: list[Phrases], padding: int) -> np.ndarray:
    """Phrases that each text needs in each language, shape (texts, languages)."""
    counts = np.ones((len(texts), len(tables)), np.int64)  # the phrase open at the end
    pieces = [max(1, -(-len(codes) // PIECE)) for codes in texts]
    at = 0
    while at < len(texts):
        end, total = at + 1, pieces[at]
        while end < len(texts) and total + pieces[end] <= PIECES:
            total += pieces[end]
            end += 1
        first = np.concatenate([[0], np.cumsum(pieces[at:end])])
        grid = np.full((total, PIECE), padding, np.uint32)
        flat = grid.reshape(-1)
        for codes, piece in zip(texts[at:end], first):
            flat[piece * PIECE : piece * PIECE + len(codes)] = codes
        letters = np.ascontiguousarray(grid.T)
        begins = np.zeros(total, bool)
        begins[first[:-1]] = True
        for n, table in enumerate(tables):
            counts[at:end, n] += np.add.reduceat(_walk(table, letters, begins), first[:-1])
        at = end
    return counts


def predict(texts: list[str], samples: Samples) -> list[tuple[str, float]]:
    """Language and score of each text: 0 where two languages fit alike, near 1 where one fits far better."""
    return [(lang, score) for lang, score, _ in _judged(texts, samples)]


def _judged(texts: list[str], samples: Samples) -> list[tuple[str, float, bool]]:
    """``predict``, and whether every other language needs more phrases than the one predicted."""
    classes, tables = letter_classes(samples.letters), phrase_tables(samples)
    if not tables:
        return [(UNDETERMINED, 0.0, False)] * len(texts)
    codes = [class_codes(text, classes) for text in texts]
    counts = count_phrases(codes, tables, len(samples.letters) + 2)
    weights = np.array([math.log2(len(text) + 1) for _, text in samples.texts])
    found = []
    for row, own in zip(counts, codes):
        if not own.size:
            found.append((UNDETERMINED, 0.0, False))
            continue
        bits = row * weights / len(own)
        best = int(bits.argmin())
        rest = np.delete(bits, best)
        score = 1.0 - float(bits[best] / rest.min()) if rest.size else 1.0
        found.append((samples.texts[best][0], score, bool((np.delete(row, best) > row[best]).all())))
    return found


def identify(
    docs: DataFrame, samples: Samples, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.

    Null texts and texts without a letter are ``und`` with score 0; so is everything if no language was learned.
    Ties go to the first language in order. A null id is not held out. Rows that repeat an id are predicted each
    by its own text; other columns are not read.
    """

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            found = predict([row["text"] or "" for row in rows], samples)
            return [(row["doc_id"], *pair) for row, pair in zip(rows, found)]

        return work

    kind_of_id = docs.schema[id_col].dataType.simpleString()
    found = map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        f"doc_id {kind_of_id}, lang_pred string, score double",
        start,
    )
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(
    docs: DataFrame,
    samples: Samples,
    wanted: Collection[str] | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The documents in a learned language (one of ``wanted``, if given), with their language as it was read.

    A text that is ``und`` goes, and so does one that another language reads in no more phrases than the one
    predicted: a few letters that occur everywhere, or letters that no language has. ``lang_col`` takes the predicted
    language; without such a column the documents are only filtered. All other columns stay.
    """

    def start() -> Callable[[list], list]:
        def judged(lang: str, score: float, decided: bool) -> str | None:
            return lang if decided and (wanted is None or lang in wanted) else None

        return lambda texts: [judged(*found) for found in _judged([t or "" for t in texts], samples)]

    return judge_rows(docs, text_col, lang_col if lang_col in docs.columns else None, start)
