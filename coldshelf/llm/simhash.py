"""Near-duplicate documents by SimHash, linked through Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments A and B of 23 bits and C of 18.
The binary Golay code (23, 12) is perfect: each 23-bit word lies within three
bits of exactly one codeword. A segment's keys are the indices of the codewords
its neighbours (itself, or one bit changed) decode to: one key, or six. Two
segments that differ in at most two bits have a common neighbour at one bit
from each at most, so they share a key.

With at most three differing bits in all (a + b + c), one of these agrees:

* c = 0: then a or b is at most 1: C itself with a key of A, or of B;
* c >= 1 and a = 0: A itself with a key of B (b is at most 2);
* c >= 1 and b = 0: B itself with a key of A;
* a = b = c = 1: a key of A, with one half of B and one half of C unchanged.

Every key has 30 bits or more, so unrelated fingerprints rarely meet, and each
candidate is verified. Equal fingerprints are one node before keys are made:
exact copies cost nothing, however many. A key that many fingerprints have is
cut into blocks, and each pair of blocks is compared by a task of its own.
Where rows meet, only the edges that keep them connected are passed on.

Near copies (``keep_one``) are a matter of similarity, the exact share of common
distinct shingles. Golay keys, and MinHash bands of three samples, only propose
which texts meet; every link is verified by the shingle hashes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from coldshelf.llm.components import components
from coldshelf.llm.shared import each_batch, free_names, written

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3

#: Near copies: shingle length and similarity (share of common shingles) from which texts are copies.
COPY_SHINGLE_WORDS = 5
COPY_SIMILARITY = 0.8
#: A sample print is a MinHash band, the majority of so many samples; so many of them are made.
PRINT_SAMPLES, PRINTS = 3, 10
#: More fingerprints with one key than this are compared block by block.
BLOCK = 512

# Fixed value: generator polynomial of the binary Golay code (23, 12).
GENERATOR = 0b110001110101


# -- fingerprints -----------------------------------------------------------


def shingle_hashes(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """Hash of each of the text's word shingles, repeats included; of the whole text where it has fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - shingle_words + 1)
    if n == 1:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        begins = [0, *(ends[: n - 1]).tolist()]
        stops = (ends[shingle_words - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[b:e], seed) for b, e in zip(begins, stops)]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the text's word shingles; zero for a text without words."""
    return majority(shingle_hashes(text, shingle_words, seed))


def majority(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The number whose bits are set in over half the hashes; zero of none."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), step):
        part = hashes[i : i + step].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def sample_prints(hashes: np.ndarray, step: int = 1 << 13) -> np.ndarray:
    """Sample prints of a text's shingle hashes; of no shingles, zeros.

    Each of some orders of all shingles picks the least in the text: two texts
    agree in one with the probability of their similarity. A sample print is a
    MinHash band, the majority of the shingles that three orders pick, so texts
    share it with the third power of that probability.
    """
    orders = _orders()
    least = np.full(len(orders), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), step):
        mixed = hashes[i : i + step, None] * orders[None, :]
        mixed ^= mixed >> np.uint64(32)
        np.minimum(least, (mixed * _ODD).min(axis=0), out=least)
    if not len(hashes):
        least[:] = 0
    a, b, c = least.reshape(PRINT_SAMPLES, PRINTS)
    return ((a & b) | (a & c) | (b & c)).view(np.int64)


_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _orders() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, PRINTS * PRINT_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def copy_prints(docs: DataFrame, shingle_words: int = COPY_SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, content, fp, prints, node)``: as ``fingerprints``, with sample prints and a hash of the distinct shingles.

    Texts of one ``node`` have the same distinct shingles: their similarity is 1.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [shingle_hashes(t, shingle_words) for t in batch.column("text").to_pylist()]
        whole = np.array([majority(h) for h in hashes], dtype=np.uint64).view(np.int64)
        prints = pa.array([sample_prints(h) for h in hashes], pa.list_(pa.int64()))
        nodes = np.array([xxhash.xxh64_intdigest(np.unique(h).tobytes(), SEED) for h in hashes], dtype=np.uint64)
        columns = [batch.column("doc_id"), batch.column("content"), pa.array(whole), prints, pa.array(nodes.view(np.int64))]
        return pa.record_batch(columns, names=["doc_id", "content", "fp", "prints", "node"])

    return _texts(docs).mapInArrow(
        each_batch(make), "doc_id long, content long, fp long, prints array<long>, node long"
    )


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, content, fp)`` for each row of ``documents``.

    ``content`` is Spark's ``xxhash64`` of the text, ``fp`` the 64 bits in a signed long.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
        bits = np.array(made, dtype=np.uint64).view(np.int64)
        columns = [batch.column("doc_id"), batch.column("content"), pa.array(bits)]
        return pa.record_batch(columns, names=["doc_id", "content", "fp"])

    return _texts(docs).mapInArrow(each_batch(make), "doc_id long, content long, fp long")


# -- Golay keys -------------------------------------------------------------


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits, and the error of each remainder."""
    low = np.array([_remainder(v) for v in range(1 << 12)], dtype=np.uint32)
    high = np.array([_remainder(v << 12) for v in range(1 << 11)], dtype=np.uint32)
    error = np.zeros(1 << 11, dtype=np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            error[_remainder(pattern)] = pattern
    return low, high, error


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the one codeword within three bits of each 23-bit word."""
    low, high, error = _tables()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ error[syndrome]) >> 11


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys: for each word the distinct codewords that it and its one-bit neighbours decode to."""
    words = words.astype(np.uint32)
    changes = np.concatenate([[0], 1 << np.arange(23)]).astype(np.uint32)
    found = np.sort(nearest_codeword(words[:, None] ^ changes[None, :]), axis=1)
    fresh = np.ones(found.shape, dtype=bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, at = np.nonzero(fresh)
    return rows, found[rows, at].astype(np.int64)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the fingerprints: any two within three bits share a key."""
    bits = fps.view(np.uint64)
    a = (bits & np.uint64((1 << 23) - 1)).astype(np.int64)
    b = (bits >> np.uint64(23) & np.uint64((1 << 23) - 1)).astype(np.int64)
    c = (bits >> np.uint64(46)).astype(np.int64)
    row_a, key_a = segment_keys(a)
    row_b, key_b = segment_keys(b)
    rows = [row_a, row_b, row_b, row_a]
    keys = [
        (0 << 60) | (c[row_a] << 12) | key_a,
        (1 << 60) | (c[row_b] << 12) | key_b,
        (2 << 60) | (a[row_b] << 12) | key_b,
        (3 << 60) | (b[row_a] << 12) | key_a,
    ]
    for i, half_b in enumerate((b & 0xFFF, b >> 12)):
        for j, half_c in enumerate((c & 0x1FF, c >> 9)):
            rows.append(row_a)
            keys.append(((4 + 2 * i + j) << 60) | (half_b[row_a] << 21) | (half_c[row_a] << 12) | key_a)
    return np.concatenate(rows), np.concatenate(keys).astype(np.int64)


# -- links ------------------------------------------------------------------


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= MAX_BITS


def _chains(fps: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links that connect what is near in each run of equal cells."""
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    sizes = np.diff(np.append(starts, len(cells)))
    left, right = [], []
    small = np.repeat(sizes <= 8, sizes)
    for lag in range(1, 8):  # of small cells, all of them at once
        i = np.flatnonzero((cells[:-lag] == cells[lag:]) & small[lag:]) if len(cells) > lag else np.empty(0, int)
        i = i[_near(fps[i], fps[i + lag])]
        left.append(fps[i])
        right.append(fps[i + lag])
    for s, n in zip(starts[sizes > 8], sizes[sizes > 8]):
        root = _spanning(fps[s : s + n])
        linked = root != np.arange(n)
        left.append(fps[s + root[linked]])
        right.append(fps[s : s + n][linked])
    return np.concatenate(left), np.concatenate(right)


def _spanning(fps: np.ndarray) -> np.ndarray:
    """For each place the first place that is reachable from it by steps between near fingerprints."""
    root = np.arange(len(fps))
    waiting = np.arange(len(fps))
    while len(waiting):
        first, front, waiting = waiting[0], waiting[:1], waiting[1:]
        while len(front):
            root[front] = first
            reached = np.zeros(len(waiting), dtype=bool)
            for i in range(0, len(front), 64):
                rest = np.flatnonzero(~reached)
                near = _near(fps[waiting[rest]][:, None], fps[front[i : i + 64]][None, :])
                reached[rest[near.any(axis=1)]] = True
            front, waiting = waiting[reached], waiting[~reached]
    return root


def _links_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: rows come sorted by cell; a cell that goes on in the next batch waits for it."""

    def linked(fps: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
        a, b = _chains(fps, cells)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("key", "cell")], axis=1)
        held.append((batch.column("fp").to_numpy(), keys))
        fps, keys = (np.concatenate(parts) for parts in zip(*held))
        new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
        last = np.flatnonzero(new)[-1]
        if last:
            yield linked(fps[:last], np.cumsum(new)[:last])
        held = [(fps[last:], keys[last:])]
    if held:
        yield linked(held[0][0], np.zeros(len(held[0][0]), dtype=np.int64))


def similar(shingles: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets of distinct shingles reachable by steps of at least the similarity."""
    sizes = np.array([len(h) for h in shingles])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    known, ids = np.unique(np.concatenate(shingles), return_inverse=True)
    waiting, found = np.arange(len(shingles)), []
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            i = front.pop()
            own = np.zeros(len(known), dtype=bool)
            own[ids[starts[i] : ends[i]]] = True
            common = np.concatenate([[0], np.cumsum(own[ids])])
            common = common[ends[waiting]] - common[starts[waiting]]
            union = sizes[i] + sizes[waiting] - common
            near = common / np.maximum(union, 1) >= similarity
            found += [(i, j) for j in waiting[near]]
            front += waiting[near].tolist()
            waiting = waiting[~near]
    return found


def _copies_in_cells(similarity: float):
    """For ``mapInArrow``: rows come sorted by cell; yields the links of each cell, verified by its shingles."""

    def linked(nodes: list[int], shingles: list[np.ndarray]) -> list[tuple[int, int]]:
        pairs = similar(shingles, similarity) if len(set(nodes)) > 1 else []
        return [(nodes[i], nodes[j]) for i, j in pairs if nodes[i] != nodes[j]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        cell, nodes, shingles = None, [], []
        for batch in batches:
            pairs = []
            for at, key in enumerate(zip(batch.column("key").to_pylist(), batch.column("cell").to_pylist())):
                if key != cell:
                    pairs += linked(nodes, shingles)
                    cell, nodes, shingles = key, [], []
                nodes.append(batch.column("node")[at].as_py())
                shingles.append(np.frombuffer(batch.column("shingles")[at].as_py(), dtype=np.uint64))
            yield made(pairs)
        yield made(linked(nodes, shingles))

    return run


def _cells(keys: DataFrame, shared: DataFrame, item: str) -> DataFrame:
    """The rows ``(key, item)`` of the keys ``shared(key, n)``, once for each cell in which they meet others."""
    mine = F.pmod(F.xxhash64(item), F.col("blocks")).cast("int")
    # Block pairs (i, j), i <= j, that hold this row's block; one cell where there is one block.
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.least(x, F.col("mine")).cast("long") * F.col("blocks") + F.greatest(x, F.col("mine")),
    )
    return (
        keys.join(shared, "key")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("mine", mine)
        .select(*keys.columns, F.explode(others).alias("cell"))
    )


def links(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """``(a, b)``: verified links that connect all fingerprints ``fp`` reachable by steps of three bits or fewer."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column("fp").to_numpy()
        rows, keys = fuzzy_keys(fps)
        return pa.record_batch([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])

    keys = distinct.select("fp").mapInArrow(each_batch(make), "key long, fp long")
    keys = written(spark, keys, "golay-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        _cells(keys, shared, "fp")
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell")
        .mapInArrow(_links_in_cells, "a long, b long")
    )


def copy_links(
    spark: SparkSession, docs: DataFrame, prints: DataFrame, shingle_words: int, similarity: float
) -> DataFrame:
    """``(a, b)``: links between nodes of ``prints`` that share a key and have the similarity by their distinct shingles.

    Keys are the Golay keys of the fingerprint and the sample prints. ``prints`` has to be written already.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes = batch.column("node").to_numpy()
        rows, keys = fuzzy_keys(batch.column("fp").to_numpy())
        return pa.record_batch([pa.array(keys), pa.array(nodes[rows])], names=["key", "node"])

    def shingled(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(t, shingle_words)).tobytes() for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    golay = prints.select("node", "fp").distinct().mapInArrow(each_batch(make), "key long, node long")
    bands = prints.select("node", "prints").distinct().select("node", F.posexplode("prints").alias("nth", "print"))
    bands = bands.select(F.xxhash64("nth", "print").alias("key"), "node")
    keys = _shared(spark, golay, "golay-keys").union(_shared(spark, bands, "band-keys"))
    # Keys of the same nodes need one comparison: copies that share many keys meet once.
    members = [F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high")]
    members += [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    shared = keys.groupBy("key").agg(*members).where("low < high")
    shared = shared.groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key")).select("key", "n")
    met = written(spark, _cells(keys, shared, "node"), "copy-cells")
    # One row of documents for each node that meets another: only these are cut into shingles again.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content")).alias("first")
    chosen = prints.join(met.select("node").distinct(), "node", "left_semi").groupBy("node").agg(first)
    chosen = chosen.select("node", F.col("first.doc_id").alias("id"), F.col("first.content").alias("hash"))
    texts = _texts(docs)
    same = texts["doc_id"].eqNullSafe(chosen["id"]) & (texts["content"] == chosen["hash"])
    texts = texts.join(chosen.hint("shuffle_hash"), same).select("node", "text")
    sets = written(spark, texts.mapInArrow(each_batch(shingled), "node long, shingles binary"), "copy-shingles")
    return (
        met.join(sets.dropDuplicates(["node"]), "node")
        .repartition("key", "cell")
        .sortWithinPartitions("key", "cell")
        .mapInArrow(_copies_in_cells(similarity), "a long, b long")
    )


def _shared(spark: SparkSession, keys: DataFrame, label: str) -> DataFrame:
    """The rows ``(key, node)`` whose key others have too, written: most keys are nobody else's."""
    keys = written(spark, keys, label)
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return written(spark, keys.join(often, "key", "left_semi"), f"shared-{label}")


def _grouped(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """``(doc_id, content, fp, component_id)``. ``prints`` has to be written already."""
    distinct = written(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    groups = components(spark, links(spark, distinct)).toDF("fp", "root")
    rooted = distinct.join(groups, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.select("doc_id", "content", "fp").join(of_print, "fp")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``documents``.

    ``component_id`` is the smallest doc_id among the documents reachable by
    links of three bits or fewer, the document itself included; null where all of
    them are null. Null, empty and blank texts have fingerprint zero and link
    like any other.
    """
    prints = written(spark, fingerprints(docs, shingle_words), "fingerprints")
    fingerprint_hex = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _grouped(spark, prints).select("doc_id", fingerprint_hex, "component_id")


def keep_one(
    spark: SparkSession,
    docs: DataFrame,
    shingle_words: int = COPY_SHINGLE_WORDS,
    similarity: float = COPY_SIMILARITY,
) -> DataFrame:
    """One row of ``documents`` for each component, with all its columns: the one of smallest doc_id, null ids last.

    Links are those of texts whose distinct shingles have the similarity, exactly
    measured. Which texts are measured is told by fingerprints of three bits or
    fewer apart and, as a fingerprint of a whole text moves by more than that where
    a few of its words differ, by common sample prints (see ``sampled``).
    Of different texts with one id the one of smallest ``content`` stays, and of
    repeated rows with the same id and text any one.
    """
    prints = written(spark, copy_prints(docs, shingle_words), "copy-prints")
    groups = components(spark, copy_links(spark, docs, prints, shingle_words, similarity)).toDF("node", "root")
    grouped = prints.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = grouped.groupBy("root", "doc_id", "content").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content", "n")).alias("first")
    kept = rows.groupBy("root").agg(first).select("first.doc_id", "first.content", "first.n")
    names = kept_id, kept_content, kept_n = free_names(docs, "kept_id", "kept_content", "kept_n")
    kept = written(spark, kept.toDF(*names), "kept")
    same = docs["doc_id"].cast("long").eqNullSafe(kept[kept_id])
    same &= F.xxhash64(docs["text"].cast("string")) == kept[kept_content]
    # Texts are not sorted for it: the kept ids, a few bytes a row, are what is hashed.
    joined = docs.join(kept.hint("shuffle_hash"), same)
    once = joined.where(F.col(kept_n) == 1)
    repeated = joined.where(F.col(kept_n) > 1).dropDuplicates([kept_id, kept_content])
    return once.unionAll(repeated).select(*[docs[c] for c in docs.columns])
