"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust a score.

The base kinds (email, ip, card, phone) always stay. Further kinds are found by
their own patterns and kept where their score reaches ``KEEP``: a bank account
number (iban) has to have its country's length and pass mod 97; a national number (ssn) has no checksum and
needs a context word nearby. Positions are code points, ends exclusive. Every
search is linear in the length of a text.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coldshelf.llm.shared import each_batch

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
KEEP = 0.5
#: Characters before and after a span in which context words count.
CONTEXT = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, so the look-behinds leave out no match.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
# Fixed value: length of an account number by its country. Of other countries, each length is tried, longest first.
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBAN_OF_LENGTH = {
    n: re.compile(
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (n // 4 - 1, r" ?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "")
    )
    for n in range(34, 14, -1)
}
_CONTEXT_WORDS = {
    "email": re.compile(r"\b(?:e-?mail|mailto|contact|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|server|host|address|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|tax id)\b", re.I),
}
_PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number's check digits are right (letters count as 10 to 35)."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of local part, ``@`` and domain; looked for around each ``@``."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _accounts(text: str) -> list[tuple[int, int]]:
    """Account numbers of their country's length and with right check digits, whatever word or number follows."""
    found, at = [], 0
    while start := _IBAN.search(text, at):
        at = start.start() + 1
        length = _IBAN_LENGTHS.get(start[1])
        for n in _IBAN_OF_LENGTH if length is None else (length,):
            m = _IBAN_OF_LENGTH[n].match(text, start.start())
            if m and mod97(m[0].replace(" ", "")):
                found.append(m.span())
                at = m.end()
                break
    return found


def _proposed(text: str) -> list[tuple[int, int, str]]:
    """Spans of all kinds whose validator, if any, agrees."""
    found = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if len(m[0]) >= 12 and 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        if "+" in text:
            found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
        found += [(a, b, "iban") for a, b in _accounts(text)]
        found += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
    return found


def find(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind. A null or empty text has none."""
    text = text or ""
    spans = []
    for start, end, kind in _proposed(text):
        near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
        score = min(1.0, _PRIOR[kind] + (0.3 if _CONTEXT_WORDS[kind].search(near) else 0.0))
        if kind in BASE_KINDS or score >= KEEP:
            spans.append(Span(start, end, kind, score))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str | None) -> str | None:
    """The text with each span, or chain of overlapping spans, replaced by ``[KIND]`` of the first.

    A masked span may uncover another (digits that had run into it), so this
    goes on until nothing is found; every round leaves fewer digits and ``@``.
    """
    while text and (spans := find(text)):
        made, at = [], 0
        for s in spans:
            if s.start >= at:
                made += [text[at : s.start], f"[{s.kind.upper()}]"]
            at = max(at, s.end)
        text = "".join(made) + text[at:]
    return text


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``documents``: counts of the base kinds, a digest of base spans, and all spans.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and
    ``scores``, the spans' scores in the same order.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t) for t in batch.column("text").to_pylist()]
        base = [[s for s in spans if s.kind in BASE_KINDS] for spans in found]
        counts = [pa.array([sum(s.kind == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS]
        digests = pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string())
        spans = pa.array([listed(s) for s in found], pa.string())
        scores = pa.array([[s.score for s in spans] for spans in found], pa.list_(pa.float64()))
        names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores"]
        return pa.record_batch([batch.column("doc_id"), *counts, digests, spans, scores], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return rows.mapInArrow(each_batch(make), f"doc_id long, {counts}, base_sha256 string, spans string, scores array<double>")


def redacted(docs: DataFrame) -> DataFrame:
    """``documents`` with personal data masked, all columns kept; ``n_chars``, where there is one, follows the text."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [redact(t) for t in batch.column("text").to_pylist()]
        i = batch.schema.get_field_index("text")
        batch = batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))
        if (i := batch.schema.get_field_index("n_chars")) >= 0:
            lengths = [None if t is None else len(t) for t in texts]
            batch = batch.set_column(i, batch.schema.field(i), pa.array(lengths, pa.int64()).cast(batch.schema.field(i).type))
        return batch

    return docs.mapInArrow(each_batch(make), docs.schema)
