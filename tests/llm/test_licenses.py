import re

from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows

from coldshelf.llm import licenses, queries


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = []
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def check(row, text):
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain(text)
    labels = row.labels.split(",")
    assert set(row.base_labels.split(",")) - {""} <= set(labels) and labels == sorted(set(labels))
    assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)


def test_query_equals_plain_words(spark):
    texts = dict(rows("documents", "doc_id, text"))
    got = queries.op10_license_scan(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        check(r, texts[r.doc_id])
    assert sum(r.n_base for r in got) > 0 and any("cc-by-nc" in r.labels for r in got)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert licenses.licenses(docs).count() == len(ODD_TEXTS)
    assert licenses.licenses(nothing(docs)).collect() == []


def test_exact_phrases():
    n, exact, _ = licenses.scan("The MIT-License, mit license; permit license. MIT licenses. éMIT License")
    assert n == 11 and [m.start for m in exact] == [1, 3]


def test_notices_with_edits():
    for text, label, words in (
        ("xx Relesed undr the MIT Lisense yy", "mit", (1, 6)),
        ("Licenced under the Apache Licence, Version 2.0 of", "apache", (0, 8)),
        ("(Licensed under CC BY-NC 4.0)", "cc-by-nc", (0, 5)),
    ):
        _, _, fuzzy = licenses.scan(text)
        assert [(m.label, (m.start, m.end)) for m in fuzzy if m.label == label][:1] == [(label, words)], fuzzy
        assert all(0 < m.score <= 1 for m in fuzzy)
    assert licenses.scan("a licensed driver under the bridge")[2] == []


class Bounded:
    """A notice with at most so many edits, by bit-parallel counting (Myers, 1999); the brute-force version."""

    def __init__(self, notice):
        self.notice = notice.text
        self.edits = notice.edits
        self._places = [0] * 256
        for i, byte in enumerate(self.notice):
            self._places[byte] |= 1 << i

    def fewest(self, line):
        """Fewest edits of the notice to any part of the line."""
        every = (1 << len(self.notice)) - 1
        top = 1 << len(self.notice) - 1
        more, less, edits = every, 0, len(self.notice)
        best = edits
        for byte in line:
            equal = self._places[byte]
            across = (((equal & more) + more) ^ more) | equal
            up = less | (every & ~(across | more))
            down = more & across
            edits += bool(up & top) - bool(down & top)
            up = up << 1
            equal |= less
            more = (down << 1 | ~(equal | up)) & every
            less = up & equal
            best = min(best, edits)
        return best


def check_line(line):
    """Each notice is found where a part of the line is within its edits, with the fewest; spans are what they say."""
    found = {}
    for start, end, label, score in licenses._fuzzy(line):
        found.setdefault(label, []).append((start, end, score))
    labels = set()
    for notice in licenses._notices():
        fewest = Bounded(notice).fewest(line)
        assert fewest == plain_edits(notice.text, line)
        if fewest <= notice.edits:
            labels.add(notice.label)
            assert max(score for _, _, score in found[notice.label]) >= 1 - fewest / len(notice.text)
    for label, spans in found.items():
        for start, end, score in spans:
            same = [n for n in licenses._notices() if n.label == label]
            assert any(abs(plain_edits(n.text, line[start:end]) - (1 - score) * len(n.text)) < 1e-6 for n in same)
    assert labels == set(found)
    return labels


def changed(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        chars[i : i + 1] = rng.choice(("", "x", chars[i] + "q", rng.choice("abcdefgh ")))
    return "".join(chars)


def test_every_place_within_the_edits_is_found():
    import random

    rng = random.Random(4)
    seen = [check_line(f"{rng.choice(['before it ', '', 'x'])}{changed(rng, n, rng.randint(0, len(n) // 10 + 2))} and after".encode()) for n, _ in licenses.NOTICES for _ in range(8)]
    assert set() in seen and len(set().union(*seen)) == 6


def test_given_texts_equal_counting():
    lines = {b" ".join((t or "").encode().translate(licenses._WORDS).split()) for _, t in rows("documents", "doc_id, text")}
    lines = sorted(line[i : i + 400] for line in lines for i in range(0, min(len(line), 4000), 380) if b"licen" in line or i == 0)
    assert len(lines) > 100
    for line in lines:
        found = {label for _, _, label, _ in licenses._fuzzy(line)}
        assert found == {n.label for n in licenses._notices() if Bounded(n).fewest(line) <= n.edits}


def plain_edits(notice, line):
    """Fewest edits of the notice to any part of the line, cell by cell."""
    column = list(range(len(notice) + 1))
    best = column[-1]
    for c in line:
        made = [0]
        for i, x in enumerate(notice):
            made.append(min(column[i] + (x != c), column[i + 1] + 1, made[i] + 1))
        column = made
        best = min(best, column[-1])
    return best


def test_whole_notices_and_all_their_edits():
    """Edits may stand close together; what only begins like a notice is not one."""
    changed = "permlsslon ls hereby qranted free of charqe to any person obtaining a copy"
    assert [(m.label, m.start, m.end) for m in licenses.scan("x " + changed + " y")[2]] == [("mit", 1, 14)]
    boost = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy"
    assert licenses.scan(boost)[2] == []
    twice = "Redistribution and use in source and binary forms, with or without modification, are permitted. " * 2
    assert [(m.label, m.start, m.end, m.score) for m in licenses.scan(twice)[2]] == [("bsd", 0, 14, 1), ("bsd", 14, 28, 1)]


def test_near_misses_are_quick():
    """Texts that share much with a notice and are none: every place is looked at, none takes long."""
    import random
    import time

    rng = random.Random(6)
    text = " ".join(changed(rng, n, len(n) // 10 + rng.randint(1, 6)) for n, _ in licenses.NOTICES * 20)
    began = time.time()
    licenses.scan(text)
    assert time.time() - began < 60
