import random
import re

import numpy as np
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows

from coldshelf.llm import decontaminate, queries


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_tiles(a, b, least=5):
    """Greedy string tiling by comparing all places: total of marked words."""
    free_a, free_b, total = [True] * len(a), [True] * len(b), 0
    for length in range(min(len(a), len(b)), least - 1, -1):
        for j in range(len(b) - length + 1):
            for i in range(len(a) - length + 1):
                if a[i : i + length] == b[j : j + length] and all(free_a[i : i + length]) and all(free_b[j : j + length]):
                    free_a[i : i + length] = free_b[j : j + length] = [False] * length
                    total += length
    return total


def plain_contaminated(docs, items, threshold=0.5):
    found = []
    windows = [({tuple(w[k : k + 5]) for k in range(len(w) - 4)}, w, i) for i, w in ((i, plain_words(t)) for i, t in items)]
    for d, text in docs:
        words = plain_words(text)
        mine = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for seeds, item, i in windows:
            if mine & seeds and (share := plain_tiles(item, words) / len(item)) >= threshold:
                found.append((d, i, round(share, 9)))
    return sorted(found, key=str)


def found(frame):
    return sorted(((r.doc_id, r.item_id, round(r.coverage, 9)) for r in frame.collect()), key=str)


def test_query_equals_plain_tiling(spark):
    want = plain_contaminated(rows("documents", "doc_id, text"), rows("benchmark", "item_id, text"))
    assert want and found(queries.op7_decontaminate(spark, SF_DIR)) == want


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
DOCS = [
    (1, "x " + ITEM.upper() + ", y"),
    (2, "nu xi omicron no more; KAPPA lambda mu nu xi omicron and then alpha-beta gamma delta epsilon zeta eta"),  # reordered
    (3, "alpha beta gamma delta epsilon and nothing else"),
    (4, "alpha x beta x gamma x delta x epsilon x zeta x eta x theta x iota"),
    (None, ITEM),
    (5, None),
    (5, ITEM),
    (5, ITEM),
    (6, "filler " * 30_000 + ITEM),
]


def test_cases(spark):
    docs = spark.createDataFrame([(*d, "c") for d in DOCS], "doc_id long, text string, content string")
    items = [(7, ITEM), (8, "too short"), (9, None), (None, ITEM), (7, ITEM), (10, "")]
    frame = spark.createDataFrame([(*i, 1.0) for i in items], "item_id long, text string, coverage double")
    want = plain_contaminated([d for d in DOCS if d[0] != 6], [i for i in items if i[0] in (7, None)]) + [(6, 7, 1.0), (6, 7, 1.0), (6, None, 1.0)]
    assert found(decontaminate.contaminated(spark, docs, frame)) == sorted(want, key=str)
    assert {r.doc_id for r in decontaminate.contaminated(spark, docs, frame).collect()} == {1, 2, None, 5, 6}
    kept = decontaminate.clean(spark, docs, frame)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([(*d, "c") for d in DOCS if d in (DOCS[2], DOCS[3], DOCS[5])], key=str)


def test_seeds_that_are_too_many_to_send_are_joined(spark, monkeypatch):
    sent = found(queries.op7_decontaminate(spark, SF_DIR))
    monkeypatch.setattr(decontaminate, "SENT_SEEDS", 10)
    assert found(queries.op7_decontaminate(spark, SF_DIR)) == sent


def test_odd_documents(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminated(spark, docs, items).collect() == []
    assert decontaminate.clean(spark, docs, items).count() == len(ODD_TEXTS)
    assert decontaminate.contaminated(spark, nothing(docs), items).collect() == []
    assert decontaminate.clean(spark, docs, nothing(items)).count() == len(ODD_TEXTS)


def test_tiles_equal_a_plain_version():
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        got = decontaminate.tiles(a, b, 3)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in got)
        assert sum(n for *_, n in got) == plain_tiles(a, b, 3)
        assert [n for *_, n in got] == sorted((n for *_, n in got), reverse=True)


def test_seeds_are_the_same_wherever_they_stand():
    lines = [decontaminate.words_of(t) for t in ("a b c d e f", "", "x x a b c d e", "a b c d", "ö b c d e f")]
    hashes, line = decontaminate.seeds_of(lines)
    assert line.tolist() == [0, 0, 2, 2, 2, 4, 4] and hashes[0] == hashes[4] and len(np.unique(hashes)) == 5
