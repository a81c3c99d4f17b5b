"""License notices in texts: exact phrases, and short notices with a bounded number of edits.

A notice that occurs with at most k edits has one of any k + 1 pieces of it
unchanged (pigeonhole). Pieces are looked up as plain strings; around each piece
found, the regex library's bounded-error matching verifies the edits and gives
the span. It does so in two steps, as its time grows fast with length and edits.
The notice is cut into parts of some 25 characters, and each is matched by itself
near where it must stand; the sum of their fewest edits is a lower bound, and
with it most places go. The whole notice is matched where the bound leaves it
possible. Texts are compared as words: A-Z lower-cased, all other ASCII but
letters and digits taken as gaps.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from coldshelf.llm.shared import each_batch

#: Phrases that must stand word for word, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Short notices, as words, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license version", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
)
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10
#: Characters of a part, and the edits up to which it is looked for first.
PART_CHARS, EASY_EDITS = 25, 2
#: Verified windows that a worker remembers.
REMEMBERED = 20_000

_WORDS = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


class Match(NamedTuple):
    start: int  # words from 0, end exclusive
    end: int
    label: str
    score: float


@cache
def _phrases() -> list[tuple[re.Pattern, bytes, str]]:
    made = []
    for phrase, label in PHRASES:
        words = phrase.encode().split()
        made.append((re.compile(rb"(?<![^ ])(?=" + b" ".join(map(re.escape, words)) + rb"(?![^ ]))"), b" ".join(words), label))
    return made


class Notice:
    """A notice, its label, the edits allowed (characters changed, added or left out), and what finds it."""

    def __init__(self, text: str, label: str) -> None:
        self.text, self.label = text.encode(), label
        n = len(self.text)
        self.edits = n // CHARS_PER_EDIT
        self.seeds = [(a, self.text[a:b]) for a, b in _cut(n, self.edits + 1)]
        parts = _cut(n, max(1, n // PART_CHARS))
        self._parts = [(a, b, _pattern(self.text[a:b], min(EASY_EDITS, self.edits)), _pattern(self.text[a:b], self.edits)) for a, b in parts]
        self._whole = _pattern(self.text, self.edits)

    def verify(self, line: bytes, start: int) -> tuple[int, int, int] | None:
        """Start, end and edits of the match with fewest edits that begins at ``start``, or up to its edits early or late.

        ``start`` is where a seed says; the match is one that has this seed unchanged.
        """
        first = start - self.edits
        before = max(0, -first)  # what the line lacks of the window
        stop = start + len(self.text) + self.edits
        at = line.find(self.text, max(0, first), stop)
        if at >= 0:
            return at, at + len(self.text), 0
        found = self._best(line[max(0, first) : stop], before)
        return found and (first + before + found[0], first + before + found[1], found[2])

    def _best(self, window: bytes, before: int) -> tuple[int, int, int] | None:
        key = (self.text, window, before)
        if key not in _verified:
            if len(_verified) >= REMEMBERED:
                _verified.clear()
            m = self._whole.search(window) if self._fewest(window, before) <= self.edits else None
            _verified[key] = m and (m.start(), m.end(), sum(m.fuzzy_counts))
        return _verified[key]

    def _fewest(self, window: bytes, before: int) -> int:
        """A number of edits that the match has at least: the fewest of its parts, each where the seed lets it be."""

        def near(pattern: regex.Pattern, a: int, b: int) -> regex.Match | None:
            return pattern.search(window, max(0, a - before), max(0, b + 2 * self.edits - before))

        fewest, hard, least = 0, [], min(EASY_EDITS, self.edits) + 1
        for a, b, easy, any_edits in self._parts:
            m = near(easy, a, b)
            fewest += sum(m.fuzzy_counts) if m else least
            if not m:
                hard.append((a, b, any_edits))
            if fewest > self.edits:
                return fewest
        for a, b, any_edits in hard:
            m = near(any_edits, a, b)
            fewest += (sum(m.fuzzy_counts) if m else self.edits + 1) - least
            if fewest > self.edits:
                break
        return fewest


_verified: dict[tuple[bytes, bytes, int], tuple[int, int, int] | None] = {}


def _cut(n: int, parts: int) -> list[tuple[int, int]]:
    cuts = [n * i // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def _pattern(text: bytes, edits: int) -> regex.Pattern:
    return regex.compile(b"(?b)(?:" + regex.escape(text) + b"){e<=%d}" % edits)


@cache
def _notices() -> list[Notice]:
    return [Notice(text, label) for text, label in NOTICES]


def _fuzzy(line: bytes) -> list[tuple[int, int, str, float]]:
    """Places of notices in a line of words, with at most their number of edits; of those that overlap, the one of fewest."""
    found = []
    for notice in _notices():
        starts = set()
        for place, seed in notice.seeds:
            at = line.find(seed)
            while at >= 0:
                starts.add(at - place)
                at = line.find(seed, at + 1)
        matches = set()
        for start in starts:
            if m := notice.verify(line, start):
                matches.add(m)
        taken: list[tuple[int, int]] = []
        for start, end, edits in sorted(matches, key=lambda m: (m[2], m[0], m[1])):
            if all(end <= a or b <= start for a, b in taken):
                taken.append((start, end))
                found.append((start, end, notice.label, 1 - edits / len(notice.text)))
    return found


def scan(text: str | None) -> tuple[int, list[Match], list[Match]]:
    """Number of words, exact phrases, and notices found by bounded-error matching. Null is empty."""
    line = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split())
    n_words = line.count(b" ") + 1 if line else 0
    exact = []
    for pattern, phrase, label in _phrases():
        length = phrase.count(b" ") + 1
        before = at = 0
        if phrase in line:
            for m in pattern.finditer(line):
                before += line.count(b" ", at, m.start())
                at = m.start()
                exact.append(Match(before, before + length, label, 1.0))
    fuzzy = []
    for start, end, label, score in _fuzzy(line):
        first = line.count(b" ", 0, start + (line[start : start + 1] == b" "))
        last = line.count(b" ", 0, end - (line[end - 1 : end] == b" "))
        fuzzy.append(Match(first, last + 1, label, score))
    return n_words, exact, fuzzy


def licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``documents``.

    Columns: doc_id, n_words, n_base (places of exact phrases), first_word and
    last_word (their smallest and largest start; null without any), base_labels
    and labels (distinct, sorted, comma-joined; the latter with those of fuzzy
    notices), score (the best match's share of characters unchanged; 0 without
    any), and ``notices``, the fuzzy matches as label:first word:end word.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(t) for t in batch.column("text").to_pylist()]
        starts = [[m.start for m in exact] for _, exact, _ in found]
        columns = {
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array([n for n, _, _ in found], pa.int64()),
            "n_base": pa.array([len(s) for s in starts], pa.int64()),
            "first_word": pa.array([min(s, default=None) for s in starts], pa.int64()),
            "last_word": pa.array([max(s, default=None) for s in starts], pa.int64()),
            "base_labels": pa.array([_labels(e) for _, e, _ in found], pa.string()),
            "labels": pa.array([_labels(e + f) for _, e, f in found], pa.string()),
            "score": pa.array([max([0.0, *(m.score for m in e + f)]) for _, e, f in found], pa.float64()),
            "notices": pa.array([",".join(f"{m.label}:{m.start}:{m.end}" for m in f) for _, _, f in found], pa.string()),
        }
        return pa.record_batch(list(columns.values()), names=list(columns))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        each_batch(make),
        "doc_id long, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double, notices string",
    )


def _labels(matches: list[Match]) -> str:
    return ",".join(sorted({m.label for m in matches}))
