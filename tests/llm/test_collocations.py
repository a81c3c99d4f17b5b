import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, duck
from helpers import nothing, odd_documents

from coldshelf.llm import collocations, queries

SCHEMA = "doc_id long, text string, lang string"


def plain(documents, min_count, longest=5, best=2000):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in documents:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    made = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if a >= min_count and len(p) > 1]
        dropped = {
            q[i : i + k] for q in candidates for k in range(2, len(q)) for i in range(len(q) - k + 1) if f[q] >= f[q[i : i + k]]
        }
        rows = []
        for p in candidates:
            if p not in dropped:
                cuts = [(1000 * f[p] * n[lang] // (f[p[:j]] * f[p[j:]]), j) for j in range(1, len(p))]
                score, j = min(cuts)
                rows.append((" ".join(p), f[p], f[p[:j]], f[p[j:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        made += [(lang, i + 1, *r) for i, r in enumerate(rows[:best])]
    return sorted(made)


def found(spark, documents, **options):
    frame = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(documents)], SCHEMA)
    return sorted(tuple(r) for r in collocations.collocations(spark, frame, **options).collect())


def noise(seed, n, alphabet="a b c d É 日本 A, . \n \t ; e f x y".split(" ")):
    rng = random.Random(seed)
    return [
        (rng.choice([None, ""]) if rng.random() < 0.05 else " ".join(rng.choices(alphabet, k=rng.randint(1, 60))), rng.choice(["en", "en", None, "", "de"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("min_count,longest,best", [(2, 5, 2000), (5, 3, 7), (3, 2, 1)])
def test_equals_counting_in_memory(spark, min_count, longest, best):
    documents = noise(min_count, 60)
    got = found(spark, documents, min_count=min_count, longest=longest, best=best)
    assert got == plain(documents, min_count, longest, best) and got


def test_small_blocks(spark):
    documents = noise(9, 40) + [("word " * 700 + "the end. " * 30, "en"), ("x" * 3000, "en")]
    assert found(spark, documents, min_count=3, block=64) == plain(documents, 3)


def test_blocks_end_with_pieces():
    codes = np.concatenate([np.append(np.ones(n, np.int32), 0) for n in (500, 3, 1, 200, 1, 64, 40, 40)])
    made = list(collocations._in_pieces(codes.astype(np.int32), 64))
    assert np.concatenate(made).tolist() == codes.tolist()
    assert all(b[-1] == 0 for b in made) and len(made) > 4


def test_words_are_never_cut():
    text = " ".join(["word"] * 50 + ["x" * 300, "end. next", "é" * 90, "."] * 5).encode()
    for size in (1, 7, 64, 10_000):
        words = collocations._Words()
        codes = np.concatenate(collocations._codes([text, b"", text], words, size)).tolist()
        names = list(words)
        kept = b" ".join(names[c] for c in codes).split()
        assert [w for w in kept if w != b"."] == 2 * text.replace(b".", b" ").split()


def test_phrases_that_never_stand_alone_go(spark):
    documents = [("new york city. new york city. york. of of of of of of", "en")] * 3
    got = found(spark, documents, min_count=3)
    assert got == plain(documents, 3)
    assert "new york city" in {r[2] for r in got} and "new york" not in {r[2] for r in got}


def test_a_block_has_one_row_for_each_shard(spark, monkeypatch):
    """Not one for each of its phrases: what is shuffled stays small."""
    rng = random.Random(4)
    documents = [(" ".join(f"w{rng.randrange(200)}" for _ in range(4000)), "en") for _ in range(6)]
    moved, common = [], collocations._common
    monkeypatch.setattr(collocations, "_common", lambda spark, rows, *rest: moved.append(rows.count()) or common(spark, rows, *rest))
    assert found(spark, documents, min_count=4, longest=2) == plain(documents, 4, 2)
    frame = spark.createDataFrame([(0, t, g) for t, g in documents], SCHEMA)
    blocks = collocations.word_blocks(frame).count()
    assert len(moved) == 2 and max(moved) <= 64 * blocks


@pytest.mark.parametrize("size,least", [(1 << 21, 1), (100, 1), (1 << 21, 7)])
def test_any_number_of_shards(spark, monkeypatch, size, least):
    monkeypatch.setattr(collocations, "SHARD", size)
    monkeypatch.setattr(collocations, "LEAST_SHARDS", least)
    documents = noise(3, 60)
    assert found(spark, documents, min_count=3, block=256) == plain(documents, 3)


def test_pairs_of_large_numbers_stay_apart():
    left, right = np.array([1 << 40, 0, 1 << 40, 1 << 40]), np.array([5, 1 << 41, 5, 1 << 41])
    made = collocations._as_one(left, right)
    assert made[0] == made[2] and len(set(made.tolist())) == 3
    for numbers in (left, -right, right[:1], np.arange(100_000)):
        assert collocations._unpacked(collocations._packed(numbers)).tolist() == numbers.tolist()


def test_odd_documents_and_empty_table(spark):
    docs = odd_documents(spark)
    got = sorted(tuple(r) for r in collocations.collocations(spark, docs, min_count=2).collect())
    assert got == plain([(r.text, r.lang) for r in docs.collect()], 2) and got
    empty = collocations.collocations(spark, nothing(docs))
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_sql_on_the_larger_tables(spark):
    """The smallest tables hold few phrases that occur 100 times."""
    sf_dir = "/root/testdata/sf0.01"
    frame = queries.op12_collocations(spark, sf_dir)
    assert differences(frame, duck(sf_dir), queries.ORACLE["op12_collocations"]) is None
    assert not frame.isEmpty()
