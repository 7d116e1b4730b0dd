"""License scans by fuzzy search for short notices.

A notice may differ from its known wording in up to k characters. Cut the
wording into k + 1 parts: k errors can't touch all of them, so at least one
part stands in the text exactly, no more than k places from where it belongs
(pigeonhole). One automaton finds all parts of all notices in a text; around
each hit the regex library's bounded-error matching decides and gives the
span and the number of edits.

Texts are compared as lower-case words joined by single spaces, so line
breaks, punctuation and mark-up between words make no difference.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# What the method searches for with errors.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "dedicated to the public domain": "public-domain",
    "licensed under the gnu general public license": "gpl",
    "the terms of the gnu general public license": "gpl",
    "the terms of the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license": "mpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "all rights reserved": "all-rights-reserved",
}
CHARS_PER_ERROR = 10    # one error for so many characters of a notice
MAX_ERRORS = 4
REMEMBERED = 20_000  # windows whose matches a task remembers

# Words are ASCII letters and digits and everything beyond ASCII.
_WORDS = {c: " " for c in range(128) if not (chr(c).isascii() and chr(c).isalnum())}
_WORDS |= {c: chr(c).lower() for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    """The words of a text, A-Z lower-cased."""
    return [w for w in (text or "").translate(_WORDS).split(" ") if w]


def errors_for(notice: str) -> int:
    return min(MAX_ERRORS, len(notice) // CHARS_PER_ERROR)


def parts(notice: str, errors: int) -> list[tuple[int, str]]:
    """The notice in errors + 1 parts of about one length, each with its place."""
    n = errors + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """The automaton of all seeds, and each notice's bounded-error pattern."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]) -> None:
        self.base, self.notices = base, list(notices.items())
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.patterns, self.errors = [], []
        for i, (notice, _) in enumerate(self.notices):
            k = errors_for(notice)
            self.errors.append(k)
            self.patterns.append(regex.compile(f"(?b)(?:{regex.escape(notice, special_only=True, literal_spaces=True)}){{e<={k}}}"))
            for at, part in parts(notice, k):
                seeds.setdefault(part, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for part, where in seeds.items():
            self.seeds.add_word(part, (len(part), where))
        for phrase in base:
            padded = f" {phrase} "
            if padded not in self.seeds:
                self.seeds.add_word(padded, (len(padded), []))
        self.seeds.make_automaton()
        self.phrases = {f" {p} ": label for p, label in base.items()}
        self.searched: dict[tuple[int, str], tuple[tuple[int, int, int], ...]] = {}

    def __call__(self, joined: str) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, int, int]]]:
        """Of words joined and padded by single spaces: (place, label) of base phrases, and (start, end, label, edits, length) of notices."""
        exact: list[tuple[int, str]] = []
        near: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.seeds.iter(joined):
            start = end - size + 1
            if (label := self.phrases.get(joined[start:end + 1])) is not None:
                exact.append((start + 1, label))
            for i, at in where:
                k, n = self.errors[i], len(self.notices[i][0])
                near.setdefault(i, []).append((max(0, start - at - k), min(len(joined), start - at + n + k)))
        found = []
        for i, windows in near.items():
            notice, label = self.notices[i]
            exactly = _exactly(joined, notice)
            found += [(a, b, label, 0, len(notice)) for a, b in exactly]
            found += [(a + x, a + y, label, edits, len(notice)) for a, b in _bounded(windows, exactly, 2 * self.errors[i])
                      for x, y, edits in self._within(i, joined[a:b])]
        return exact, _closest(found)

    def _within(self, i: int, window: str) -> tuple[tuple[int, int, int], ...]:
        """(start, end, edits) of notice i in a window; what repeats word for word is searched once."""
        if (got := self.searched.get((i, window))) is None:
            if len(self.searched) >= REMEMBERED:
                self.searched.clear()
            got, todo, least = [], [(0, len(window))], len(self.notices[i][0]) - self.errors[i]
            # The best match of a window comes first wherever it stands: others stand before and behind it.
            while todo:
                a, b = todo.pop()
                if b - a >= least and (m := self.patterns[i].search(window, a, b)):
                    got.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                    todo += [(a, m.start()), (m.end(), b)]
            self.searched[i, window] = got = tuple(got)
        return got


def _exactly(joined: str, notice: str) -> list[tuple[int, int]]:
    """Where a notice stands without an edit, from left to right."""
    out, at = [], joined.find(notice)
    while at >= 0:
        out.append((at, at + len(notice)))
        at = joined.find(notice, at + len(notice))
    return out


def _bounded(windows: list[tuple[int, int]], exactly: list[tuple[int, int]], apart: int) -> Iterator[tuple[int, int]]:
    """Windows to search, without what stands there exactly.

    Windows that begin within ``apart`` characters are one place's, seen from
    several seeds, and become one; others stay windows of their own, so that
    each is about as long as a notice however many notices follow each other.
    What several windows find is weighed by ``_closest``.
    """
    begins = [a for a, _ in exactly]
    united: list[tuple[int, int]] = []
    first = None
    for a, b in sorted(set(windows)):
        if first is not None and a - first <= apart:
            united[-1] = (united[-1][0], max(b, united[-1][1]))
        else:
            united.append((a, b))
            first = a
    for a, b in united:
        # Cut by the exact places that it touches, which are few: they don't overlap each other.
        i = max(bisect.bisect_right(begins, a) - 1, 0)
        while i < len(exactly) and exactly[i][0] < b:
            if exactly[i][1] > a:
                if exactly[i][0] > a:
                    yield a, exactly[i][0]
                a = exactly[i][1]
            i += 1
        if a < b:
            yield a, b


def _closest(found: list[tuple[int, int, str, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """Of notices that overlap in the text, the one with the fewest edits for its length, then the longest, then the first."""
    out: list[tuple[int, int, str, int, int]] = []
    kept: list[tuple[int, int]] = []  # their spans in order
    for x in sorted(set(found), key=lambda x: (x[3] / x[4], -x[4], x[0], x[2], x[1])):
        i = bisect.bisect_left(kept, (x[0], x[1]))
        if (i == 0 or kept[i - 1][1] <= x[0]) and (i == len(kept) or x[1] <= kept[i][0]):
            kept.insert(i, (x[0], x[1]))
            out.append(x)
    return out


@lru_cache(maxsize=4)
def _scanner(base: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(dict(base), dict(notices))


def _places(text: str) -> list[tuple[int, int]]:
    """Start and end of each word in the text."""
    return [m.span() for m in WORD.finditer(text)]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base: dict[str, str] | None = None,
         notices: dict[str, str] | None = None) -> DataFrame:
    """One row for each row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` lists each notice found as label:start:end:edits in code points of
    the text, by start and label. ``score`` is 1 where a base phrase stands,
    else the best notice's share of characters without an edit, else 0. Null
    and empty texts have no words. Repeated rows repeat; an empty table gives
    an empty one. Other columns are not read.
    """
    base, notices = tuple((BASE if base is None else base).items()), tuple((NOTICES if notices is None else notices).items())
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(base, notices)
        for t in it:
            rows = [_row(scanner, x.as_py() or "") for x in t.column("text")]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([t.column("doc_id"), *[pa.array(c, y) for c, y in zip(cols, types, strict=True)]], names)

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                               "labels string, score double, spans string")


def _row(scanner: Scanner, text: str) -> tuple:
    words = words_of(text)
    joined = f" {' '.join(words)} "
    exact, near = scanner(joined)
    if not exact and not near:
        return len(words), 0, None, None, "", "", 0.0, ""
    at, word, first, last = 0, -1, None, None
    for place, _ in sorted(exact):
        word, at = word + joined.count(" ", at, place), place
        first, last = (word if first is None else first), word
    spans = []
    if near:
        places = _places(text)
        at = word = 0
        for start, end, label, edits, _ in sorted(near):
            # The words that the match begins and ends in.
            word, at = word + joined.count(" ", at, start), start
            begin = word if joined[start] == " " else word - 1
            until = begin + joined.count(" ", start + (joined[start] == " "), end - (joined[end - 1] == " "))
            until = min(until, len(places) - 1)
            spans.append(f"{label}:{places[min(max(begin, 0), until)][0]}:{places[until][1]}:{edits}")
    score = 1.0 if exact else max(1 - edits / n for _, _, _, edits, n in near)
    own = sorted({label for _, label in exact})
    every = sorted({*own, *(x[2] for x in near)})
    return len(words), len(exact), first, last, ",".join(own), ",".join(every), score, ",".join(spans)
