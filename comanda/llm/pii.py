"""Personal data in texts: patterns propose, checksums confirm, context scores.

Patterns propose spans per kind, leftmost and without overlap. Confirmation is a rule of the kind: parts of an
address at most 255, Luhn for cards, a count of digits for phones, mod 97 for bank accounts, the entropy of a
credential's characters. What passes has a
base score, which words near the span raise. The four base kinds stay whatever their score; the further kinds
count from a score of ``MIN_SCORE``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
MIN_SCORE = 0.6
CONTEXT_CHARS, CONTEXT_BONUS = 48, 0.3

# The patterns of the base kinds as the contract gives them. The look-behind of IP changes no
# match (a later start in one run of digits fails as the first does) and keeps long runs linear.
EMAIL_NAME = "[A-Za-z0-9._%+-]"
EMAIL_HOST = r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further kinds: bank accounts (mod 97) and nine-digit identity numbers in three groups.
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"
IDENTITY = r"\b(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\b"
# Credentials: long runs of one alphabet (base64, its form for addresses, hexadecimal).
CREDENTIAL = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
# Bits a character that a run of one alphabet must have; random ones of 20 characters lie above, words below.
HEX_BITS, BASE64_BITS = 2.5, 3.6
HEX = re.compile("[0-9A-Fa-f]+")

DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """The checksum of card numbers: every second digit from the right doubled."""
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The checksum of bank accounts: letters as 10 to 35, the first four characters last."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _card(found: str) -> bool:
    digits = "".join(DIGITS.findall(found))
    return 16 <= len(digits) <= 19 and luhn(digits)


def _iban(found: str) -> bool:
    account = found.replace(" ", "")
    return 15 <= len(account) <= 34 and mod97(account)


def entropy(found: str) -> float:
    """Bits a character by the counts of the characters."""
    return -sum(n / len(found) * math.log2(n / len(found)) for n in Counter(found).values())


def _credential(found: str) -> bool:
    """Letters and digits mixed as by chance."""
    found = found.rstrip("=")
    if not DIGITS.search(found) or not re.search("[A-Za-z]", found):
        return False
    return entropy(found) >= (HEX_BITS if HEX.fullmatch(found) else BASE64_BITS)


_NAME_CHARS = frozenset(c for c in map(chr, range(128)) if re.fullmatch(EMAIL_NAME, c))
_HOST = re.compile(EMAIL_HOST)


def find_emails(text: str) -> Iterable[tuple[int, int]]:
    """Matches of name, @ and host from left to right, found from each @ so that long runs stay linear."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _NAME_CHARS:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def _matches(pattern: str) -> Callable[[str], Iterable[tuple[int, int]]]:
    compiled = re.compile(pattern)
    return lambda text: (match.span() for match in compiled.finditer(text))


@dataclass(frozen=True)
class Kind:
    name: str
    find: Callable[[str], Iterable[tuple[int, int]]]
    valid: Callable[[str], bool]
    needs: str  # a text without any of these characters holds no match
    score: float
    context: re.Pattern


def _words(*words: str) -> re.Pattern:
    return re.compile("|".join(words), re.IGNORECASE)


KINDS = (
    Kind("email", find_emails, lambda m: True, "@", 0.7, _words("mail", "contact", "write", "reply")),
    Kind(
        "ip",
        _matches(IP),
        lambda m: all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.split(".")),
        ".",
        0.5,
        _words(r"\bip\b", "address", "host", "server"),
    ),
    Kind("card", _matches(CARD), _card, "0123456789", 0.6, _words("card", "visa", "credit", "payment")),
    Kind(
        "phone",
        _matches(PHONE),
        lambda m: 8 <= len(DIGITS.findall(m)) <= 15,
        "+",
        0.5,
        _words("phone", "tel", "call", "mobile", "fax"),
    ),
    Kind("iban", _matches(IBAN), _iban, "0123456789", 0.7, _words("iban", "account", "bank")),
    Kind(
        "identity",
        _matches(IDENTITY),
        lambda m: True,
        "-",
        0.4,
        _words("social", "security", "ssn", "identity", "tax"),
    ),
    Kind(
        "credential",
        _matches(CREDENTIAL),
        _credential,
        "0123456789",
        0.4,
        _words("token", "secret", "passw", r"\bpwd\b", "credential", "bearer", r"\bauth", r"(api|access|private|account)[\s_-]?key"),
    ),
)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind and start; code points, end exclusive."""
    spans = []
    for kind in KINDS:
        if not any(c in text for c in kind.needs):
            continue
        for start, end in kind.find(text):
            if not kind.valid(text[start:end]):
                continue
            near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
            score = min(1.0, kind.score + CONTEXT_BONUS * bool(kind.context.search(near)))
            if kind.name in BASE_KINDS or score >= MIN_SCORE:
                spans.append((kind.name, start, end, score))
    return spans


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``pii``, an array of (kind, start, end, score).

    The whole text is searched. Null and empty texts have no spans; rows that repeat an id, or have none, each
    give a row; other columns are not read. An empty table gives an empty table.
    """

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(rows: list[dict]) -> Iterable[tuple]:
            for row in rows:
                spans = find_spans(row["text"] or "")
                yield row["doc_id"], [dict(zip(("kind", "start", "end", "score"), s)) for s in spans]

        return work

    kind_of_id = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
        f"doc_id {kind_of_id}, pii array<struct<kind:string,start:bigint,end:bigint,score:double>>",
        start,
    )


def span_digest(found: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of ``personal_data``."""
    as_text = lambda spans: F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("pii")).alias("spans"),
    )
