"""Words of freely typed values: cleaning, edit distance, abbreviations, and a lookup of the nearest known words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Known words an executor holds at a time, and words a lookup remembers.
VOCABULARY, MEMORY = 50_000, 200_000

_LOOKALIKE = str.maketrans({"0": "o", "1": "l", "3": "e", "5": "s", "$": "s", "@": "a"})
_WORD = re.compile(r"[^\W_]+(?:[/'][^\W_]+)*", re.UNICODE)


def fold(text: str) -> str:
    """Lower case without accents; digits misread inside a word become the letters they stand for."""
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    mix = lambda m: m.group().translate(_LOOKALIKE) if re.search(r"[a-z]{2}", m.group()) else m.group()
    return re.sub(r"[a-z0-9$@]*[a-z][a-z0-9$@]*", mix, text)


def words(text: str) -> list[str]:
    """The words of a folded text in order; a slash or apostrophe inside a word is dropped (o/s, son's)."""
    return [re.sub(r"[/']", "", w) for w in _WORD.findall(text)]


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours counted as one, or ``most + 1`` if larger."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    before, last = None, list(range(m + 1))
    for i in range(1, n + 1):
        row = [i] + [0] * m
        x = a[i - 1]
        for j in range(1, m + 1):
            y = b[j - 1]
            d = last[j - 1] + (x != y)
            if row[j - 1] + 1 < d:
                d = row[j - 1] + 1
            if last[j] + 1 < d:
                d = last[j] + 1
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            row[j] = d
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[m] if last[m] <= most else most + 1


def allowed_edits(length: int) -> int:
    """Edits taken for a typing error in a word of this length (of the shorter of two words)."""
    return 0 if length <= 2 else 1 if length <= 4 else 2


def abbreviates(short: str, full: str) -> bool:
    """True if ``short`` keeps the first letter of ``full`` and some of its later ones in order."""
    if not 2 <= len(short) < len(full) or short[0] != full[0]:
        return False
    rest = iter(full)
    return all(c in rest for c in short)


class KnownWords:
    """The nearest of a bounded list of known words, with a memory of the words asked before."""

    def __init__(self, known: list[str]):
        self.known = sorted(set(known))
        self.same = frozenset(self.known)
        self.memory: dict[str, tuple[str, list[str]]] = {}
        self.by_gram: dict[str, list[int]] = {}
        for i, w in enumerate(self.known):
            for g in self._grams(w):
                self.by_gram.setdefault(g, []).append(i)
        self.by_first: dict[str, list[str]] = {}
        for w in self.known:
            self.by_first.setdefault(w[:1], []).append(w)

    def longer(self, word: str) -> list[str]:
        """The known words of more than three letters that a word of two or more may be short for, letter by letter."""
        if len(word) < 2:
            return []
        return [c for c in self.by_first.get(word[:1], ()) if len(c) > 3 and len(word) <= 0.8 * len(c) and all(ch in rest for rest in [iter(c)] for ch in word)]

    @staticmethod
    def _grams(w: str) -> set[str]:
        padded = f"^{w}$"
        return {padded[i : i + 2] for i in range(len(padded) - 1)} | {c + "*" for c in w}

    def nearest(self, word: str) -> tuple[str, list[str]]:
        """How the word is known, and as what: ``same``, ``typo`` (all words at the least distance),
        ``short`` (all words it may abbreviate), or ``none``."""
        if word in self.memory:
            return self.memory[word]
        out = decide(word, *self.candidates(word))
        if len(self.memory) < MEMORY:
            self.memory[word] = out
        return out

    def candidates(self, word: str) -> tuple[int, list[str], list[str]]:
        """The least distance of a known word (3: none is near enough), the known words at it, and those it may abbreviate."""
        if word in self.same:
            return 0, [word], []
        best, found = 3, []
        votes: dict[int, int] = {}
        for g in self._grams(word):
            for i in self.by_gram.get(g, ()):
                if abs(len(self.known[i]) - len(word)) <= 2:
                    votes[i] = votes.get(i, 0) + 1
        for i, n in votes.items():
            w = self.known[i]
            most = min(best, allowed_edits(min(len(word), len(w))))
            if most and n >= 2 and abs(len(w) - len(word)) <= most and (d := edits(word, w, most)) <= most:
                if d < best:
                    best, found = d, []
                found.append(w)
        shorts = [w for w in self.by_first.get(word[:1], ()) if len(word) <= 0.8 * len(w) and abbreviates(word, w)]
        return best, found, shorts


def decide(word: str, best: int, found: list[str], shorts: list[str]) -> tuple[str, list[str]]:
    """How a word is known, and as what, from its candidates (``KnownWords.nearest``)."""
    if best == 0:
        return "same", [word]
    if found and best == 1 and not (len(word) <= 3 and shorts):
        return "typo", sorted(found)
    if shorts and (not found or len(word) <= 5):
        return "short", sorted({*shorts, *found})
    return ("typo", sorted(found)) if found else ("none", [])


RESOLVED = "w string, how string, near array<string>"
_CANDIDATES = "w string, best int, found array<string>, shorts array<string>, longer array<string>"


def resolve(asked: DataFrame, known: DataFrame, longer: bool = False) -> DataFrame:
    """Each distinct word (column ``w``) with how it is known and as which known words (column ``w``; schema ``RESOLVED``).

    Any number of known words: they are taken in blocks of about ``VOCABULARY``, the only ones that executors hold, each
    asked word is held against every block, and what the blocks say is put together, as one block would say it.
    With ``longer``, a word that may be short for longer known words stands for these too.
    """
    known = known.select("w").where("w is not null").distinct()
    blocks = max(1, -(-known.count() // VOCABULARY))
    parts = []
    for block in range(blocks):
        listed = [r["w"] for r in known.where(F.pmod(F.xxhash64("w"), F.lit(blocks)) == block).collect()]  # about VOCABULARY

        def run(batches: Iterator[pd.DataFrame], listed: list[str] = listed) -> Iterator[pd.DataFrame]:
            index = KnownWords(listed)
            for pdf in batches:
                rows = [(w, *index.candidates(w), index.longer(w) if longer else []) for w in pdf["w"]]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in _CANDIDATES.split(", ")])

        parts.append(asked.select("w").mapInPandas(run, _CANDIDATES))
    if blocks == 1:
        merged = parts[0]
    else:
        least = F.min("best").alias("best")
        lists = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("shorts", "longer")]
        found = F.collect_list(F.struct("best", "found")).alias("all")
        merged = reduce(DataFrame.unionByName, parts).groupBy("w").agg(least, found, *lists)
        at_best = F.flatten(F.transform(F.filter("all", lambda x: x["best"] == F.col("best")), lambda x: x["found"]))
        merged = merged.select("w", "best", at_best.alias("found"), "shorts", "longer")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for w, best, found, shorts, more in zip(*(pdf[c] for c in ("w", "best", "found", "shorts", "longer"))):
                how, near = decide(w, int(best), list(found), list(shorts))
                if len(more) and (w not in near or len(w) <= 5):
                    near = sorted({*(near or [w]), *more})
                rows.append((w, how, near))
            yield pd.DataFrame(rows, columns=["w", "how", "near"])

    return merged.mapInPandas(settle, RESOLVED)
