"""Small hand-made tables and plain Python counterparts of the operators."""

from __future__ import annotations

import hashlib
import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GAP = re.compile(r"[\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def doc_rows(texts, lang="en", first=0):
    return [(n, t, lang, "s", None if t is None else len(t)) for n, t in enumerate(texts, first)]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def words_of(text) -> list[str]:
    return [w for w in GAP.split((text or "").translate(AZ)) if w]


def shingles(text, size: int) -> set:
    words = words_of(text)
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[n : n + size]) for n in range(len(words) - size + 1)}


def groups(docs: dict, size: int) -> dict:
    """doc_id -> smallest reachable id, over all pairs."""
    sets = {i: shingles(t, size) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in ids}


def line_dedup(docs: dict, min_docs: int = 5) -> dict:
    """doc_id -> (text, lines, dropped)."""
    holders: dict = {}
    key = lambda line: line.strip(SPACE).translate(AZ)
    for i, text in docs.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != i)]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def passages(docs: dict, items: dict) -> dict:
    """(doc, item) -> best weighted similarity of an item-sized window, over all windows."""
    from collections import Counter

    grams = lambda t: [tuple(w[n : n + 5]) for w in [words_of(t)] for n in range(len(w) - 4)]
    found = {}
    for item, text in items.items():
        b = grams(text)
        if not b:
            continue
        for i, doc in docs.items():
            a = grams(doc)
            if not set(a) & set(b):
                continue
            for start in range(max(len(a) - len(b), 0) + 1):
                window = a[start : start + len(b)]
                both = sum((Counter(window) & Counter(b)).values())
                share = both / (len(window) + len(b) - both)
                if 100 * both >= 80 * (len(window) + len(b) - both):
                    found[i, item] = max(found.get((i, item), 0), share)
    return found


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
