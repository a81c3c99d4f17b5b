import math
import random
import zlib

import numpy as np
import public_tokenizers
from helpers import SF_DIR, nothing, odd_documents, rows
from tokenizers import Tokenizer

from coldshelf.llm import packing, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def plain_pieces(documents, capacity):
    made = []
    for doc_id, text in documents:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]
        places = list(range(len(ids), 0, -capacity))[::-1]
        for k, end in enumerate(places):
            start = places[k - 1] if k else 0
            made.append((doc_id, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    return sorted(made, key=repr)


def check_places(got, capacity):
    """Sequences are gapless from 0 and never too long; how many there are."""
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_query_packs_every_piece_once(spark):
    got = queries.op13_best_fit(spark, SF_DIR).collect()
    want = plain_pieces(rows("documents", "doc_id, text"), 2048)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    used = check_places(got, 2048)
    assert used <= 1.02 * math.ceil(sum(w[3] for w in want) / 2048) + 1


def test_odd_documents_in_short_sequences(spark):
    docs = odd_documents(spark)
    pieces = packing.cut(docs, VOCABULARY, capacity=64)
    got = packing.pack(spark, pieces, capacity=64, open_bins=3, task_pieces=100, fan_in=2).collect()
    want = plain_pieces([(r.doc_id, r.text) for r in docs.collect()], 64)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    check_places(got, 64)


def test_empty_table(spark):
    pieces = packing.cut(nothing(odd_documents(spark)), VOCABULARY)
    assert packing.pack(spark, pieces).collect() == []


def test_other_columns_go_along(spark):
    data = [(i, None if i % 2 else "x", 1 + i * 7 % 50, True) for i in range(500)]
    frame = spark.createDataFrame(data, "key int, sequence string, length long, still_open boolean")
    got = packing.pack(spark, frame, capacity=50, open_bins=4, task_pieces=60, fan_in=3).collect()
    assert sorted(tuple(r)[:4] for r in got if r.sequence) == sorted(d for d in data if d[1])
    assert len(got) == 500
    check_places(got, 50)


def test_ids_of_pieces(spark):
    got = packing.cut(odd_documents(spark), VOCABULARY, capacity=100, with_ids=True).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def plain_best_fit(lengths, capacity, limit):
    """Bins as plain lists of free space, looked through one by one."""
    bins, closed = [], []
    for length in lengths:
        fits = [b for b in bins if b[0] >= length]
        if fits:
            best = min(fits, key=lambda b: b[0])
        else:
            if len(bins) == limit:
                fullest = min(bins, key=lambda b: b[0])
                bins.remove(fullest)
                closed.append(fullest[1])
            best = [capacity, []]
            bins.append(best)
        best[0] -= length
        best[1].append(length)
        if not best[0]:
            bins.remove(best)
            closed.append(best[1])
    return sorted(map(sorted, closed + [b[1] for b in bins]))


def test_bins_equal_a_plain_search():
    rng = random.Random(3)
    for limit in (1, 2, 5, 50):
        lengths = [rng.randint(1, 40) if rng.random() < 0.7 else rng.randint(1, 100) for _ in range(400)]
        bins = packing.OpenBins(100, limit)
        for length in lengths:
            bins.put(length, length)
            assert bins.count <= limit
        got = sorted(sorted(item for item, _ in held) for _, held in bins.rest())
        assert sum(map(len, got)) == 400
        # Bins of equal free space may be told apart differently: the fill of each must agree.
        assert sorted(map(sum, got)) == sorted(map(sum, plain_best_fit(lengths, 100, limit)))


def test_a_hundredth_is_wasted_at_most(spark):
    rng = random.Random(4)
    lengths = [min(2048, int(rng.lognormvariate(6.3, 1.0)) + 1) for _ in range(30_000)]
    frame = spark.createDataFrame([(n,) for n in lengths], "length long")
    got = packing.pack(spark, frame, open_bins=512, task_pieces=4000).collect()
    assert check_places(got, 2048) <= 1.01 * sum(lengths) / 2048
