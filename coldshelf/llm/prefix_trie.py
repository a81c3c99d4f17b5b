"""The prefix trie of conversations, and totals over its subtrees by centroid decomposition.

A node is a distinct sequence of first turns, so conversations that begin alike
share nodes. A turn is known by the SHA-256 of its role and text. A sequence is
known by the exclusive or of 128-bit hashes of its turns with their places,
under a key drawn anew for each run: two different sequences have the same one
with a probability of 2^-128, whatever the texts. So all prefixes are running
aggregates, and a conversation of any length is spread over many tasks.

Subtree totals: a component of the parent-edge forest is split at its centroid,
the deepest node below which (itself included) lies more than half of the
component's mass. The total below the centroid is added to all nodes from the
centroid to the component's top; what hangs below it, and what is left above
it, are components again, each of at most half the mass. The mass of a node is
the number of conversations through it, so that the mass below a node is known
from counting and needs no walk; rounds are at most the logarithm of all turns.
Where a component has at most ``limit`` turns, one task finishes it by the same
steps on arrays. Larger components number less than all turns / ``limit``, and
``limit`` is at least a 65,536th of all turns: only tables of their centroids
are broadcast.

Rows without a conversation id belong to none and are left out. A null role or
text is empty, a null turn comes first, rows of one turn are ordered by the
SHA-256 of role and text, repeated rows are turns of their own. Further columns
are not read. An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from coldshelf.llm.shared import written

ROOT = bytes(16)
#: Turns of one conversation in a block of the running aggregates.
BLOCK = 1024
#: Turns up to which one task finishes a component; more only if that is less than a 65,536th of all.
LIMIT = 1 << 14
#: Conversation ids of a node's end that are moved as one row.
CHUNK = 512


def ordered_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, content, n_bytes)``: each turn's place in its conversation, from 1.

    ``content`` stands for role and text, ``n_bytes`` counts the text's UTF-8 bytes.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.unhex(F.sha2(F.concat(F.sha2(role, 256), text), 256)).alias("content")
    order = ["conv_id", "turn", "content"]
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", content, F.octet_length(text).cast("long").alias("n_bytes")
    )
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
    schema = "conv_id long, content binary, n_bytes long, part int, nth long"
    numbered = written(spark, sorted_turns.mapInArrow(_numbered, schema), "turns")
    # A conversation that goes on from an earlier part is the first of its part: one row a part.
    counts = numbered.groupBy("conv_id", "part").agg(F.max("nth").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("conv_id", "part", F.sum("n").over(earlier).alias("before")).where("before > 0")
    pos = (F.col("nth") + F.coalesce("before", F.lit(0))).alias("pos")
    return numbered.join(F.broadcast(before), ["conv_id", "part"], "left").select("conv_id", pos, "content", "n_bytes")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, conv, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = batch.column("conv_id").to_numpy()
        at = np.arange(len(ids))
        starts = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
        nth = at - np.repeat(starts, np.diff(np.append(starts, len(ids)))) + 1
        if ids[0] == conv:
            nth[ids == conv] += count
        conv, count = ids[-1], nth[-1]
        batch = batch.append_column("part", pa.array(np.full(len(ids), part, dtype=np.int32)))
        yield batch.append_column("nth", pa.array(nth, pa.int64()))


def prefix_trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each node of the trie of ``turns`` (as from ``ordered_turns``) of the conversations ``convs(conv_id)``.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``. A node is named by its depth and its smallest
    conversation; the root, of depth 0, has all conversations, those without
    turns too. ``n_leaves`` and ``saved_tokens`` are totals of the subtree:
    nodes without children, and bytes of the last text for each conversation but
    one. ``ends_sha256`` is over the ids of the conversations that end there.
    """
    convs = written(spark, convs.select("conv_id").distinct(), "convs")
    path = written(spark, _paths(turns), "paths")
    nodes = written(spark, _nodes(path, convs), "nodes")
    totals = subtree_totals(spark, nodes, path, ["leaf", "tokens"], limit)
    children = nodes.where(F.col("depth") > 0).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    turnless = convs.join(path.where("pos = 1"), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = _ends(spark, path.where("pos = n").select("node", "conv_id").union(turnless))
    full = nodes.join(totals, "node").join(children, "node", "left").join(ends, "node", "left")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(parents, "parent", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaf_total").alias("n_leaves"),
        F.col("tokens_total").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` of ``prefix_trie`` with the columns of ``turns(conv_id, pos, ...)`` of each node's last turn; null at the root."""
    last = turns.withColumnRenamed("pos", "depth")
    return nodes.join(last, ["conv_id", "depth"], "left")


def _paths(turns: DataFrame) -> DataFrame:
    """``turns`` with the ``node`` that each leads to, the one before it (``parent``), and the conversation's length ``n``."""
    keys = [secrets.randbits(62) for _ in range(2)]
    own = [F.xxhash64(F.lit(k), "pos", "content").alias(f"own{i}") for i, k in enumerate(keys)]
    block = F.floor((F.col("pos") - 1) / BLOCK).alias("block")
    turns = turns.select("conv_id", "pos", "n_bytes", block, *own)
    blocks = turns.groupBy("conv_id", "block").agg(
        F.count("*").alias("rows"), F.bit_xor("own0").alias("own0"), F.bit_xor("own1").alias("own1")
    )
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(
        *("conv_id", "block", F.sum("rows").over(whole).alias("n")),
        *(F.coalesce(F.bit_xor(f"own{i}").over(earlier), F.lit(0).cast("long")).alias(f"before{i}") for i in (0, 1)),
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = turns.select("*", *(F.bit_xor(f"own{i}").over(so_far).alias(f"inside{i}") for i in (0, 1)))
    ends = [F.col(f"inside{i}").bitwiseXOR(F.col(f"before{i}")) for i in (0, 1)]
    begins = [e.bitwiseXOR(F.col(f"own{i}")) for i, e in enumerate(ends)]
    return inside.join(before, ["conv_id", "block"]).select(
        "conv_id", "pos", _name(ends).alias("node"), _name(begins).alias("parent"), "n_bytes", "n"
    )


def _name(halves: list[Column]) -> Column:
    return F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in halves)))


def _nodes(path: DataFrame, convs: DataFrame) -> DataFrame:
    """``(node, parent, conv_id, depth, n_convs, mass, leaf, tokens)``; the root's parent is null."""
    found = path.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.min("pos").alias("depth"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("n") - F.col("pos") + 1).alias("mass"),
        F.min("n_bytes").alias("n_bytes"),
    )
    below = path.agg(F.count("*").alias("below"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").join(below)
    root = root.select(
        *(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id"),
        *(F.lit(0).cast("long").alias("depth"), "n_convs", (F.col("n_convs") + F.col("below")).alias("mass")),
        F.lit(0).cast("long").alias("n_bytes"),
    )
    # Where no conversation goes on, the mass below is that of the node alone.
    leaf = (F.col("mass") == F.col("n_convs")).cast("long").alias("leaf")
    tokens = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("tokens")
    return found.unionByName(root).select("node", "parent", "conv_id", "depth", "n_convs", "mass", leaf, tokens)


def subtree_totals(
    spark: SparkSession, nodes: DataFrame, path: DataFrame, values: list[str], limit: int = LIMIT
) -> DataFrame:
    """``(node, <value>_total, ...)``: the sum of each value over the node and all below it.

    ``nodes`` are ``(node, parent, conv_id, depth, mass, *values)``, where
    ``mass`` already covers all below a node. ``path`` has ``(conv_id, pos, node,
    parent)`` for the conversations that nodes are named by.
    """
    whole = nodes.agg(F.max("mass")).first()[0] or 0
    limit = max(limit, whole >> 16)
    adds, totals = [f"{v}_add" for v in values], [f"{v}_total" for v in values]
    nothing = [F.lit(0).cast("long").alias(a) for a in adds]
    left = nodes.select("node", "parent", "conv_id", "depth", "mass", *values, *nothing, F.lit(ROOT).alias("comp"))
    done, small = [], []
    if whole > limit:
        path = written(spark, _named_paths(nodes, path), "named-paths")
    while True:
        tops = left.where("node = comp").select("comp", F.col("mass").alias("whole"), F.col("depth").alias("top"))
        large = tops.where(F.col("whole") > limit)
        if large.isEmpty():
            small.append(left)
            break
        small.append(left.join(F.broadcast(large), "comp", "left_anti"))
        active = left.join(F.broadcast(large), "comp")
        # More than half lies below the nodes of one path from the top: the last of them is the centroid.
        centroids = active.where(2 * F.col("mass") > F.col("whole")).groupBy("comp", "top").agg(
            F.max_by(F.struct("node", "conv_id", "depth", "mass"), "depth").alias("at")
        )
        centroids = written(spark, centroids, "centroids")
        at = centroids.select("comp", F.col("at.node").alias("centroid"), F.col("at.depth").alias("cut"))
        beyond = path.join(F.broadcast(at), path["parent"] == F.col("centroid"))
        beyond = beyond.select("conv_id", "comp", F.col("node").alias("child"))
        below = F.col("child").isNotNull() & (F.col("depth") > F.col("cut"))
        split = active.drop("whole", "top").join(F.broadcast(at), "comp").join(beyond, ["conv_id", "comp"], "left")
        split = split.withColumn("below", below | (F.col("node") == F.col("centroid")))
        split = written(spark, split.withColumn("child", F.when(below, F.col("child"))), "split")
        sums = split.where("below").groupBy("comp").agg(*(F.sum(v).alias(f"{v}_sum") for v in values))
        sums = written(spark, sums, "sums")
        done.append(
            split.where("node = centroid").join(F.broadcast(sums), "comp").select(
                "node", *((F.col(a) + F.col(f"{v}_sum")).alias(t) for v, a, t in zip(values, adds, totals))
            )
        )
        ways = centroids.join(sums, "comp").select(
            *("top", F.col("at.conv_id").alias("conv_id"), F.col("at.depth").alias("cut"), F.col("at.mass").alias("gone")),
            *(f"{v}_sum" for v in values),
        )
        up = path.join(F.broadcast(ways), "conv_id").where((F.col("pos") >= F.col("top")) & (F.col("pos") < F.col("cut")))
        up = up.select("node", "gone", *(f"{v}_sum" for v in values))
        zero = F.lit(0).cast("long")
        left = split.where("node <> centroid").join(up, "node", "left").select(
            *("node", "parent", "conv_id", "depth", (F.col("mass") - F.coalesce("gone", zero)).alias("mass"), *values),
            *((F.col(a) + F.coalesce(f"{v}_sum", zero)).alias(a) for v, a in zip(values, adds)),
            F.coalesce("child", "comp").alias("comp"),
        )
        left = written(spark, left, "left")
    rest = reduce(DataFrame.union, [s.select(*left.columns) for s in small]).repartition("comp").sortWithinPartitions("comp", "depth")
    schema = ", ".join(["node binary", *(f"{t} long" for t in totals)])
    return reduce(DataFrame.union, done, rest.mapInArrow(_finish(values, limit), schema))


def _named_paths(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """The paths of conversations that some node is named by, with the root at place 0."""
    names = nodes.select("conv_id").distinct()
    rows = path.select("conv_id", "pos", "node", "parent").join(names, "conv_id", "left_semi")
    root = names.select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent")
    )
    return rows.union(root)


def _finish(values: list[str], limit: int):
    """Totals of whole components that come in order of component and depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            comps = batch.column("comp").to_pylist()
            begins = [i for i in range(1, len(comps)) if comps[i] != comps[i - 1]]
            if held and comps and comps[0] != held[-1].column("comp")[-1].as_py():
                begins.insert(0, 0)
            start = 0
            for i in begins:
                if sum(b.num_rows for b in held) + i - start >= limit or i == begins[-1]:
                    yield from totals([*held, batch.slice(start, i - start)])
                    held, start = [], i
            held.append(batch.slice(start))
        yield from totals(held)

    def totals(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([p for p in parts if p.num_rows]) if any(p.num_rows for p in parts) else None
        if table is None:
            return
        names, parents, comps = (table.column(c).to_pylist() for c in ("node", "parent", "comp"))
        place = {name: i for i, name in enumerate(names)}
        parent = np.array([-1 if n == c else place[p] for n, p, c in zip(names, parents, comps)])
        own, add = (np.stack([table.column(v + s).to_numpy() for v in values]) for s in ("", "_add"))
        found = decomposed(parent, table.column("mass").to_numpy().copy(), own, add.copy())
        yield pa.record_batch([table.column("node").combine_chunks(), *map(pa.array, found)], names=["node", *(f"{v}_total" for v in values)])

    return run


def decomposed(parent: np.ndarray, mass: np.ndarray, own: np.ndarray, add: np.ndarray) -> np.ndarray:
    """``add`` plus the totals of ``own`` over each node's subtree, by centroid decomposition of many trees at once.

    ``parent`` is -1 at the tops; ``mass``, of all below a node, is positive.
    """
    parent = parent.copy()
    depth = np.zeros(len(parent), dtype=np.int64)
    levels = [np.flatnonzero(parent < 0)]
    order = np.argsort(parent, kind="stable")
    firsts = np.searchsorted(parent[order], np.arange(len(parent) + 1))
    while True:
        counts = firsts[levels[-1] + 1] - firsts[levels[-1]]
        if not counts.sum():
            break
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        levels.append(order[np.repeat(firsts[levels[-1]], counts) + steps])
        depth[levels[-1]] = len(levels) - 1
    comp = np.arange(len(parent))
    for level in levels[1:]:
        comp[level] = comp[parent[level]]
    by_depth = np.concatenate(levels)
    left = np.ones(len(parent), dtype=bool)
    total = np.zeros_like(own)
    while left.any():
        at = by_depth[left[by_depth]]
        heavy = at[2 * mass[at] > mass[comp[at]]]
        deepest = np.full(len(parent), -1)
        deepest[comp[heavy]] = heavy  # in order of depth: the last one stays
        centroid = deepest[deepest >= 0]
        below = np.zeros(len(parent), dtype=bool)
        below[centroid] = True
        cut, moved = below.copy(), comp.copy()
        for level in levels[1:]:
            level = level[left[level] & (parent[level] >= 0)]
            over = parent[level]
            moved[level] = np.where(cut[over], level, np.where(below[over], moved[over], moved[level]))
            below[level] |= below[over]
        sums = np.zeros_like(own)
        under = np.flatnonzero(below)
        for value, into in zip(own, sums):
            np.add.at(into, comp[under], value[under])
        sums = sums[:, comp[centroid]]
        total[:, centroid] = add[:, centroid] + sums
        gone, way = mass[centroid], parent[centroid]
        while (way >= 0).any():
            on = way >= 0
            way, gone, sums = way[on], gone[on], sums[:, on]
            add[:, way] += sums
            mass[way] -= gone
            way = parent[way]
        left[centroid] = False
        parent[(parent >= 0) & cut[parent]] = -1
        comp = moved
    return total


def _ends(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the SHA-256 of each node's conversation ids, ascending, joined by commas.

    Ids travel in chunks, so that a node of very many ends is some rows for the
    one task that must hash it from first to last; it holds a chunk at a time.
    """

    def runs(nodes: list, least: int) -> Iterator[tuple[int, int]]:
        start = 0
        for i in range(1, len(nodes) + 1):
            if i == len(nodes) or nodes[i] != nodes[start] or i - start == least:
                yield start, i
                start = i

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            made = [(nodes[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in runs(nodes, CHUNK)]
            if made:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made), (pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            made = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    made.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(ids.encode())
            if made:
                yield pa.record_batch([pa.array(c) for c in zip(*made)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.record_batch([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    order = ["node", "conv_id"]
    sorted_ends = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    chunked = written(spark, sorted_ends.mapInArrow(chunks, "node binary, first long, ids string"), "ends")
    return chunked.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends_sha256 string")
