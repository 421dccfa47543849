"""Quality rules learned as a decision list.

Statistics of each whole text are counted in Python over Arrow batches. Rules are learned on the driver from a
bounded sample of labelled rows by sequential covering: a rule grows by the threshold condition with the best
information gain, is pruned on rows set aside, and the rows it covers are removed before the next one. The
list is emitted as one ordered ``CASE`` expression, which Spark evaluates beside the statistics.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import SPACE, map_rows

# Rows of statistics that the fit may see: a bounded sample by hash of the id, whatever the size of the input.
SAMPLE_ROWS = 4_000
MAX_RULES, MAX_CONDITIONS, CUTS = 24, 4, 48
MIN_PRECISION, MIN_COVERED = 0.9, 4

# Characters that count as symbols, and the base thresholds of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_commas",
    "max_word_run",
)

_SPACE_BYTES = np.frombuffer(SPACE.encode(), np.uint8)
_SYMBOL_BYTES = np.frombuffer(SYMBOLS.encode(), np.uint8)
_MARK_BYTES = np.frombuffer(b"!?", np.uint8)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered = end = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def _dup_lines(text: str) -> int:
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line in seen:
            repeated += bool(line.strip(SPACE))
        else:
            seen.add(line)
    return repeated


def _longest_run(words: list[bytes]) -> int:
    """The most times that one word follows itself, itself included."""
    best = run = 0
    last = None
    for word in words:
        run = run + 1 if word == last else 1
        best = max(best, run)
        last = word
    return best


def text_counts(text: str) -> tuple[int, ...]:
    """The figures named in ``COUNTS``, from the whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly [\x20\x09-\x0D]
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return (
        len(words),
        len(text) - int(seen[_SPACE_BYTES].sum()),
        int(seen[_SYMBOL_BYTES].sum()),
        _dup_lines(text),
        _repeat_words(words),
        text.count("\n") + 1,
        len(set(words)),
        int(seen[65:91].sum()),
        int(seen[48:58].sum()),
        int(seen[_MARK_BYTES].sum()),
        int(seen[44]),
        _longest_run(words),
    )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every row; a null text counts as empty."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        return lambda rows: [(row["doc_id"], *text_counts(row["text"] or "")) for row in rows]

    kind_of_id = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        f"doc_id {kind_of_id}, " + ", ".join(f"{name} bigint" for name in COUNTS),
        start,
    )


def features() -> dict[str, Column]:
    """Figures that the rules may test, free of the length of a text where that makes sense."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "repeated_share": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "distinct_share": F.col("n_distinct_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "marks_per_word": F.col("n_marks") / words,
        "commas_per_word": F.col("n_commas") / words,
        "word_run": F.col("max_word_run").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.cut if self.at_least else values <= self.cut

    def column(self, value: Column) -> Column:
        return value >= F.lit(self.cut) if self.at_least else value <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The rows among ``rows`` (indices) that meet every condition."""
    for condition in rule:
        rows = rows[condition.holds(data[condition.feature][rows])]
    return rows


def _gain(hit: int, miss: int, hit0: int, miss0: int) -> float:
    """FOIL's information gain of narrowing from (hit0, miss0) to (hit, miss)."""
    if not hit:
        return 0.0
    return hit * (math.log2(hit / (hit + miss)) - math.log2(hit0 / (hit0 + miss0)))


def _best_condition(data: dict[str, np.ndarray], rows: np.ndarray, bad: np.ndarray) -> Condition | None:
    best, best_gain = None, 1e-9
    target = bad[rows]
    hit0, miss0 = int(target.sum()), int((~target).sum())
    for name, column in data.items():
        values = column[rows]
        order = np.unique(values)
        if len(order) < 2:
            continue
        middles = (order[1:] + order[:-1]) / 2
        if len(middles) > CUTS:
            middles = middles[np.linspace(0, len(middles) - 1, CUTS).astype(int)]
        for cut in middles:
            above = values >= cut
            hit, miss = int((target & above).sum()), int((~target & above).sum())
            for at_least, h, m in ((True, hit, miss), (False, hit0 - hit, miss0 - miss)):
                gain = _gain(h, m, hit0, miss0)
                if gain > best_gain:
                    best, best_gain = Condition(name, at_least, float(cut)), gain
    return best


def _grow(data: dict[str, np.ndarray], rows: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS and len(rows) and not bad[rows].all():
        condition = _best_condition(data, rows, bad)
        if condition is None:
            break
        rule = (*rule, condition)
        rows = _covers((condition,), data, rows)
    return rule


def _worth(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray, bad: np.ndarray) -> tuple[float, int]:
    covered = bad[_covers(rule, data, rows)]
    hit = int(covered.sum())
    return (hit - (len(covered) - hit)) / max(1, len(covered)), hit


def _prune(rule: Rule, data: dict[str, np.ndarray], rows: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest leading part of the rule that does best on rows set aside."""
    parts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (*_worth(part, data, rows, bad), -len(part)), default=rule)


def learn_rules(data: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules, each of which condemns the rows that it covers."""
    rules: list[Rule] = []
    rest = np.arange(len(bad))
    while len(rules) < MAX_RULES and bad[rest].any() and not bad[rest].all():
        aside = rest % 3 == 2
        grow, prune = rest[~aside], rest[aside]
        rule = _prune(_grow(data, grow, bad), data, prune, bad)
        if not rule:
            break
        covered = _covers(rule, data, rest)
        hits = int(bad[covered].sum())
        if hits < MIN_COVERED or hits < MIN_PRECISION * len(covered):
            break
        rules.append(rule)
        rest = np.setdiff1d(rest, covered)
    return rules


def decision(rules: list[Rule], values: dict[str, Column]) -> Column:
    """The list as one ordered conditional: false at the first rule that holds, else true."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(values[condition.feature])
        verdict = F.when(holds, F.lit(False)).otherwise(verdict)
    return verdict


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules from at most ``sample_rows`` labelled documents, taken by hash of the id.

    Rows without an id or a label are not used. A document with two labels counts as good if one says so. No
    labels, or labels of one kind only, give no rules.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(sample_rows)
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    labelled = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    labelled = labelled.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))  # at most sample_rows ids
    counts = text_statistics(labelled.select(F.struct("_doc", "_label").alias("doc_id"), "text"))
    values = features()
    rows = (
        counts.select("doc_id._doc", "doc_id._label", *[c.alias(n) for n, c in values.items()])
        .orderBy(F.xxhash64("_doc"), *values)
        .limit(sample_rows)
        .collect()
    )
    data = {name: np.array([row[name] for row in rows], float) for name in values}
    return learn_rules(data, np.array([row["_label"] == 0 for row in rows], bool))


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every document with ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Rows that repeat an id, or have none, are judged each by its
    own text. An empty table gives an empty table.
    """
    counts = text_statistics(docs, id_col, text_col)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counts.withColumn("base_failed", base_failed).withColumn(
        "kept", ~F.col("base_failed") & decision(rules, features())
    )
