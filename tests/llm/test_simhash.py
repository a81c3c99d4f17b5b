import random

import numpy as np
import xxhash
from helpers import ODD_TEXTS, SF_DIR, nothing, odd_documents, rows

from coldshelf.llm import queries, simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    """By comparing all pairs. Null ids sort last."""
    prints = np.array(prints, dtype=np.uint64)
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    order = [10**18 if i is None else i for i in ids]
    label = np.array(order)
    while True:
        lower = np.array([label[row].min() for row in close])
        if (lower == label).all():
            return [None if x == 10**18 else int(x) for x in label]
        label = lower


def expected(documents):
    prints = [plain_fingerprint(t) for _, t in documents]
    groups = plain_components([i for i, _ in documents], prints)
    return sorted(((i, f"{p:016x}", g) for (i, _), p, g in zip(documents, prints, groups)), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query_equals_all_pairs(spark):
    assert found(queries.op2_simhash(spark, SF_DIR)) == expected(rows("documents", "doc_id, text"))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert found(simhash.near_duplicates(spark, docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert found(simhash.near_duplicates(spark, nothing(docs))) == []


def test_nearest_codeword_is_within_three_bits():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000).astype(np.uint32)
    index = simhash.nearest_codeword(words)
    codewords = np.array([(int(i) << 11) | simhash._remainder(int(i) << 11) for i in index], dtype=np.uint32)
    assert np.bitwise_count(codewords ^ words).max() <= 3
    rows_, keys = simhash.segment_keys(words)
    assert set(np.bincount(rows_).tolist()) == {1, 6}


def test_prints_within_three_bits_always_share_a_key():
    rng = random.Random(2)
    for bits in (0, 1, 2, 3):
        for _ in range(400):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), bits))
            r, k = simhash.fuzzy_keys(np.array([x, y], dtype=np.uint64).view(np.int64))
            assert set(k[r == 0]) & set(k[r == 1])


def test_a_key_with_many_prints_loses_no_link(spark, monkeypatch):
    """A chain of 300 fingerprints in few keys, compared in blocks of 16, and a far-off group."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(3)
    prints = [0]
    while len(prints) < 300:
        prints.append(prints[-1] ^ sum(1 << b for b in rng.sample(range(20), 3)))
    prints = list(set(prints)) + [0x7FFF << 46, (0x7FFF << 46) + 1]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    from coldshelf.llm.components import components

    got = {r.node: r.component for r in components(spark, simhash.links(spark, frame)).collect()}
    groups = {}
    for p, g in zip(prints, plain_components(prints, prints)):
        groups.setdefault(g, set()).add(p)
    for members in groups.values():
        if len(members) > 1:
            assert {got[m] for m in members} == {min(members)}


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_are_found_and_other_texts_left_alone(spark):
    """Copies with one word in fifty changed: nearly all that are similar enough go, and nothing else does."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    originals = [[rng.choice(words) for _ in range(rng.randint(60, 400))] for _ in range(60)]
    texts = [" ".join(w) for w in originals]
    for w in originals[:30]:
        for _ in range(3):
            texts.append(" ".join(rng.choice(words) if rng.random() < 0.02 else x for x in w))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(spark, frame).collect()}
    assert set(range(60)) <= kept
    near = lambda i, j: len(shingle_set(texts[i]) & shingle_set(texts[j])) / len(shingle_set(texts[i]) | shingle_set(texts[j]))
    similar = [i for i in range(60, len(texts)) if near(i, (i - 60) // 3) >= 0.82]
    assert similar and len([i for i in similar if i not in kept]) >= 0.95 * len(similar)


def test_similar_texts_share_sample_prints():
    rng = np.random.default_rng(3)
    shared, own = rng.integers(0, 1 << 62, (2, 2000)).astype(np.uint64)
    a, b = np.concatenate([shared, own[:200]]), np.concatenate([shared, own[200:400]])
    mine = simhash.sample_prints(a)
    assert len(mine) == simhash.PRINTS and (mine == simhash.sample_prints(b)).any()
    assert not (mine == simhash.sample_prints(own[:500])).any()
    assert (simhash.sample_prints(a[::-1], step=100) == mine).all()
    assert simhash.sample_prints(own[:0]).tolist() == [0] * simhash.PRINTS


def exact_groups(texts, similarity=0.8):
    """Smallest place of each text's group, by comparing the shingles of all pairs."""
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    while any(label[i] != label[j] for i, j in pairs):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_copies_are_what_exact_similarity_says(spark, monkeypatch):
    """Pairs from 0.6 to 0.95, and texts of one repeated line: nothing below 0.8 goes, also across blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(12)
    new = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    texts = []
    for k in range(120):
        words = new(200)
        own = round(200 * (0.02 + 0.25 * k / 120))
        texts += [" ".join(words), " ".join(words[: 200 - own] + new(own))]
    line = new(6)
    texts += [" ".join(line * 60 + new(20)) for _ in range(6)]
    prints = [simhash.fingerprint(t, 5) for t in texts[-6:]]
    assert any((x ^ y).bit_count() <= 3 for x in prints for y in prints if x != y)
    base = new(300)
    for _ in range(20):
        texts.append(" ".join(w if rng.random() > 0.01 else "changed" for w in base))
    label = exact_groups(texts)
    kept = {r.doc_id for r in simhash.keep_one(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept == set(label) and 60 < len(label) - len(kept) < 150


def test_given_documents_below_the_similarity_all_stay(spark):
    docs = rows("documents", "doc_id, text")
    label = exact_groups([t for _, t in docs])
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(spark, frame).collect()}
    groups = {}
    for (i, _), g in zip(docs, label):
        groups.setdefault(g, set()).add(i)
    assert kept == {min(g) for g in groups.values()} and len(kept) < len(docs)
