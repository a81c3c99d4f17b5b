import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import SF_DIR, rows
from pyspark.sql import functions as F

from coldshelf.llm import prefix_trie as trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).digest()


def in_order(data):
    """Turns of each conversation as (role, text)."""
    made = defaultdict(list)
    for conv, turn, role, text, *_ in data:
        if conv is not None:
            role, text = role or "", text or ""
            made[conv].append(((turn is not None, turn or 0, sha(sha(role).hex() + text)), (role, text)))
    return {c: [turn for _, turn in sorted(t)] for c, t in made.items()}


def plain_rebuilt(convs):
    made = {}
    for c, own in convs.items():
        head = zlib.crc32(str(c).encode()) % 9
        base = int(c - np.fmod(c, 5))
        made[c] = convs.get(base, [])[:head] + own[head:]
    return made


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        worth = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += worth
    made = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        made.append((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(made)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query_equals_a_trie_in_memory(spark):
    got = found(queries.op11_prefix_trie(spark, SF_DIR))
    assert got == plain_trie(plain_rebuilt(in_order(rows("conversations", "conv_id, turn, role, text"))))


def noisy(seed, n):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        turn = rng.choice([None, 0, 1, 1, 2, 3, 4, 5])
        data.append((rng.choice([None, -7, -5, -3, -1, 0, 1, 2, 3, 4, 5, 6, 9, 10, 14]), turn, rng.choice([None, "", "user"]), rng.choice([None, "", "é", "ab"])))
    return data + data[: n // 3]


@pytest.mark.parametrize("seed,limit", [(1, 1), (2, 6), (3, 1000)])
def test_odd_conversations_split_at_any_size(spark, seed, limit):
    data = noisy(seed, 60)
    frame = spark.createDataFrame([(*d, "x", 1) for d in data], SCHEMA + ", node string, depth int")
    turns = trie.ordered_turns(spark, frame)
    got = found(trie.prefix_trie(spark, *queries.rebuilt(spark, turns), limit=limit))
    assert got == plain_trie(plain_rebuilt(in_order(data)))


def test_long_chains_and_copies(spark):
    rng = random.Random(5)
    long = [(0, i, "user", f"t{i}") for i in range(330)]
    branches = [(c, i, "user", f"t{i}" if i < 40 * c else f"own {c} {i}") for c in range(1, 6) for i in range(40 * c + 3)]
    copies = [(c, i, "user", f"t{i}") for c in range(100, 130) for i in range(4)]
    data = long + branches + copies
    rng.shuffle(data)
    frame = spark.createDataFrame(data, SCHEMA)
    turns = trie.ordered_turns(spark, frame)
    convs = frame.select("conv_id").distinct().union(spark.createDataFrame([(-1,), (-2,)], "conv_id long"))
    want = plain_trie(in_order(data) | {-1: [], -2: []})
    assert found(trie.prefix_trie(spark, turns, convs, limit=100)) == want


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    turns = trie.ordered_turns(spark, frame)
    assert found(trie.prefix_trie(spark, *queries.rebuilt(spark, turns))) == []


def test_last_turns_of_nodes(spark):
    data = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a")]
    turns = trie.ordered_turns(spark, spark.createDataFrame(data, SCHEMA))
    nodes = trie.prefix_trie(spark, turns, turns.select("conv_id"))
    texts = spark.createDataFrame([(c, t + 1, x) for c, t, _, x in data], "conv_id long, pos long, text string")
    got = {(r.conv_id, r.depth): r.text for r in trie.node_turns(nodes, texts).collect()}
    assert got == {(1, 0): None, (1, 1): "a", (1, 2): "b"}


def test_totals_of_random_forests():
    rng = np.random.default_rng(6)
    for n in (1, 2, 7, 300):
        for reach in (1, 3, n):
            parent = np.array([-1 if i == 0 or rng.random() < 0.02 else rng.integers(max(0, i - reach), i) for i in range(n)])
            own = rng.integers(-5, 50, (2, n))
            add = rng.integers(0, 9, (2, n))
            mass, want = rng.integers(1, 4, n), own.copy()
            for i in range(n - 1, 0, -1):
                if parent[i] >= 0:
                    want[:, parent[i]] += want[:, i]
                    mass[parent[i]] += mass[i]
            assert (trie.decomposed(parent, mass.copy(), own, add.copy()) == want + add).all()


def test_ranges_cut_a_long_conversation(spark):
    """Places go on where one conversation fills several parts."""
    frame = spark.range(5000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.lit("x").alias("text"))
    got = trie.ordered_turns(spark, frame.union(frame.limit(10).withColumn("conv_id", F.lit(8))))
    places = got.groupBy("conv_id").agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).collect()
    assert sorted(map(tuple, places)) == [(7, 1, 5000, 5000), (8, 1, 10, 10)]
