"""Phrase collocations by set-oriented mining (SETM; Houtsma and Swami, 1995).

The occurrence relation holds, in order of piece and position, every word of
the corpus. Relation k holds the occurrences of frequent phrases of k words.
It is merge-joined with itself at the next position of the same piece, which
gives the occurrences of phrases of k + 1 words whose two parts are frequent;
these are counted by phrase, and a semi-join with the frequent ones leaves
relation k + 1. Each relation is written to the shared folder; what led to it,
tables and shuffle files, is deleted then.

A relation is written in blocks: a block has whole pieces of one language.
Position p of a block holds the number of the phrase that begins there, or 0
where none does; one position is left empty between pieces, so adjacent
positions are those of one piece and a merge-join is a comparison of an array
with itself. Blocks are kept compressed, as later relations are nearly empty: a
task holds one block at a time in full. Only the distinct phrases of a block are
shuffled, with their counts, so a word of any frequency counts once a block. They
are dealt into shards by hash; what a block has for a shard is one compressed row,
and a shard is counted at a time. Phrases are told apart by the exact numbers of
their two parts, never by hashes. There is no bound on the number of words or
phrases: shards are as many as keep the mean one below ``SHARD`` entries.

Only ``text`` and ``lang`` are read; a null text is empty, a null language is
``und``. Repeated rows count each time. An empty table gives no phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from coldshelf.llm.shared import slices, small
from coldshelf.session import scratch_dir

#: Positions of a block; a single longer piece is a block of its own.
BLOCK = 1 << 20
#: Bytes of text split at a time.
SLICE = 1 << 18
#: Blocks of a task are numbered by the positions before them, below this many bits for the task.
_TASK_BITS = 41

#: Phrases of blocks that are counted at a time, in the mean, and the least number of shards.
SHARD, LEAST_SHARDS = 1 << 21, 64

_BORDER = b"."
#: A-Z to a-z, piece ends to a full stop, which no word can then contain.
_PLAIN = bytes(
    46 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256)
)
_SHARDS = 64


def collocations(
    spark: SparkSession, docs: DataFrame, min_count: int = 100, longest: int = 5, best: int = 2000, block: int = BLOCK
) -> DataFrame:
    """The ``best`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase has 2 to ``longest`` words and occurs ``a`` times, ``min_count``
    at least. Of its cuts into two parts that occur ``l`` and ``r`` times, the
    one with the lowest floor(1000 * a * n / (l * r)) counts, then the first;
    ``n`` is the number of words of the language. A phrase that never occurs
    without one more word beside it, always the same, is left out.
    """
    found, words = frequent_phrases(spark, docs, min_count, longest, block)
    grown = (
        found.where(F.col("k") > 2)
        .select((F.col("k") - 1).alias("k"), F.explode(F.array("left_id", "right_id")).alias("id"), F.col("a").alias("longer"))
        .groupBy("k", "id")
        .agg(F.max("longer").alias("longer"))
    )
    kept = found.where(F.col("k") > 1).join(grown, ["k", "id"], "left")
    kept = kept.where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    parts = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    cuts = kept.select("lang", "phrase", "k", "a", cut.alias("cut")).select(
        *("lang", "phrase", "a", "cut"),
        F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"),
    )
    counts = found.select("lang", "phrase", "a")
    cuts = cuts.join(counts.toDF("lang", "first", "l"), ["lang", "first"])
    cuts = cuts.join(counts.toDF("lang", "rest", "r"), ["lang", "rest"])
    cuts = cuts.join(F.broadcast(words) if words.count() <= 100_000 else words, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "anlr"}
    score = F.call_function("div", wide["a"] * wide["n"] * 1000, wide["l"] * wide["r"])
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n")
    scored = scored.agg(F.min(F.struct("score", "cut", "l", "r")).alias("c")).select(
        "lang", "phrase", "a", "c.l", "c.r", "n", "c.score"
    )
    # The best of each shard first, so that no task ranks a whole language.
    shard = F.pmod(F.xxhash64("phrase"), F.lit(_SHARDS)).alias("shard")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    scored = scored.select("*", shard).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "shard").orderBy(order)))
    scored = scored.where(F.col("rank") <= best)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order)).cast("long"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def frequent_phrases(
    spark: SparkSession, docs: DataFrame, min_count: int = 100, longest: int = 5, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``longest`` words, and the words ``n`` of each ``lang``.

    A phrase is ``(id, lang, phrase, k, a, left_id, right_id)``: ``left_id`` and
    ``right_id`` are the phrases without its last and without its first word.
    Ids are distinct among phrases of equal k.
    """
    texts = _Kept(spark, word_blocks(docs, block), "words")
    words = _Kept(spark, texts.rows.groupBy("lang").agg(F.sum("n").alias("n")), "totals").rows
    shards = max(LEAST_SHARDS, (words.agg(F.sum("n")).first()[0] or 0) // SHARD)
    rows = texts.rows.mapInArrow(_listed(shards), "shard int, block long, place int, lang string, words binary, n binary")
    common = _common(spark, rows, _read_words, {"lang": pa.string(), "word": pa.binary()}, min_count, shards)
    found = _phrases(common, "lang", "word").select(
        *("id", "lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("k"), "a"),
        *(F.lit(None).cast("long").alias(c) for c in ("left_id", "right_id")),
    )
    levels = [_Kept(spark, found, "phrases").rows]
    held = texts
    relation = texts.rows.select("block", "codes", F.lit(None).cast("binary").alias("ids"))
    for k in range(2, longest + 1):
        following = _Kept(spark, _semi_join(relation, common.rows, shards), "relation")
        held.drop()
        common.drop()
        held, relation = following, following.rows
        rows = relation.mapInArrow(_counted(shards), "shard int, block long, place int, pairs binary")
        common = _common(spark, rows, _read_pairs, {"left_id": pa.int64(), "right_id": pa.int64()}, min_count, shards)
        first = levels[-1].select(F.col("id").alias("left_id"), "lang", F.col("phrase").alias("head"))
        last = levels[-1].select(F.col("id").alias("right_id"), F.element_at(F.split("phrase", " "), -1).alias("tail"))
        found = _phrases(common, "left_id", "right_id").join(first, "left_id").join(last, "right_id")
        phrase = F.concat_ws(" ", "head", "tail").alias("phrase")
        found = _Kept(spark, found.select("id", "lang", phrase, F.lit(k).alias("k"), "a", "left_id", "right_id"), "phrases").rows
        if found.isEmpty():
            break
        levels.append(found)
    held.drop()
    common.drop()
    return reduce(DataFrame.union, levels), words


class _Kept:
    """A table in the shared folder, until it is dropped. The shuffle files of its making go when it is complete."""

    _CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, frame: DataFrame, label: str) -> None:
        self._spark, self._path = spark, scratch_dir(spark, label)
        before = spark.conf.get(self._CLEANUP, "false")
        spark.conf.set(self._CLEANUP, "true")
        try:
            frame.write.parquet(self._path)
        finally:
            spark.conf.set(self._CLEANUP, before)
        self.rows = spark.read.schema(frame.schema).parquet(self._path)

    def drop(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def _common(
    spark: SparkSession,
    rows: DataFrame,
    read: Callable[[pa.Table], tuple[list[int], np.ndarray, np.ndarray, np.ndarray, Callable]],
    parts: dict[str, pa.DataType],
    min_count: int,
    shards: int,
) -> _Kept:
    """Frequent phrases, from rows that hold what one block has for one shard.

    A row with a block says at which places of it which phrases begin; a row
    without one lists phrases: their ids, counts and two parts. ``read`` gives
    the entries of each row of a shard, two numbers and the count of each entry,
    and what names the parts of some entries.
    """
    lists = {"id": pa.int64(), "a": pa.int64()} | parts
    types = {"block": pa.int64(), "places": pa.binary(), "ids": pa.binary()} | {c: pa.list_(t) for c, t in lists.items()}
    spark_types = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}

    def count(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        sizes, left, right, n, named = read(table)
        pairs, first, which = np.unique(_as_one(left, right), return_index=True, return_inverse=True)
        a = np.bincount(which, n).astype(np.int64)
        often = a >= min_count
        ids = (np.cumsum(often) - 1) * shards + shard
        made: list[tuple] = []
        end = 0
        for size, block, place in zip(sizes, table.column("block").to_pylist(), table.column("place").to_pylist()):
            own = which[end : end + size]
            end += size
            at = np.flatnonzero(often[own])
            if len(at):
                made.append((block, _packed(place + at), _packed(ids[own[at]]), None, None, None, None))
        if made:
            made.append((None, None, None, ids[often], a[often], *named(first[often])))
        columns = list(zip(*made)) or [()] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    schema = ["block long", "places binary", "ids binary", *(f"{c} array<{spark_types[t]}>" for c, t in lists.items())]
    return _Kept(spark, rows.groupBy("shard").applyInArrow(count, ", ".join(schema)), "common")


def _phrases(common: _Kept, *parts: str) -> DataFrame:
    return common.rows.where("block IS NULL").select(F.inline(F.arrays_zip("id", "a", *parts)))


def _as_one(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers, equal for equal pairs only."""
    width = int(right.max()) + 1
    if (int(left.max()) + 1) * width >= 1 << 63:
        left, right = (np.unique(x, return_inverse=True)[1] for x in (left, right))
        width = int(right.max()) + 1
    return left * width + right


def _read_words(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, Callable]:
    counts = [_unpacked(n) for n in table.column("n").to_pylist()]
    sizes = [len(n) for n in counts]
    words = [w for joined in table.column("words").to_pylist() for w in zstandard.decompress(joined).split(b" ")]
    words = pa.array(words, pa.binary()).dictionary_encode()
    langs = table.column("lang").combine_chunks().dictionary_encode()
    left, right = np.repeat(langs.indices.to_numpy().astype(np.int64), sizes), words.indices.to_numpy().astype(np.int64)

    def named(entries: np.ndarray) -> tuple[list[str], list[bytes]]:
        return langs.dictionary.take(pa.array(left[entries])).to_pylist(), words.dictionary.take(pa.array(right[entries])).to_pylist()

    return sizes, left, right, np.concatenate(counts), named


def _read_pairs(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, Callable]:
    rows = [_unpacked(pairs).reshape(3, -1) for pairs in table.column("pairs").to_pylist()]
    left, right, n = np.concatenate([r[0].cumsum() for r in rows]), *(np.concatenate([r[i] for r in rows]) for i in (1, 2))
    return [r.shape[1] for r in rows], left, right, n, lambda entries: (left[entries], right[entries])


class _Words(dict):
    """The code of each word, dealt in the order in which words come."""

    def __init__(self) -> None:
        self[_BORDER] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def word_blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(block, lang, n, words, counts, codes)``: word i of a block has code i + 1; code 0 stands between pieces.

    The words of a block are in the order of their hashes, so those of a shard stand together.
    """

    def row(number: int, lang: str, words: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        counts = np.bincount(codes, minlength=len(words))
        counts[0] = 0
        used = np.flatnonzero(counts)
        used = used[np.argsort(_hashes(words[used]), kind="stable")]
        own = np.zeros(len(counts), dtype=np.int32)
        own[used] = np.arange(1, len(used) + 1)
        columns = [
            *(pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())])),
            pa.array([words[used].tolist()], pa.list_(pa.binary())),
            *(pa.array([counts[used]], pa.list_(pa.int64())), pa.array([_packed_codes(own[codes])], pa.binary())),
        ]
        return pa.record_batch(columns, names=["block", "lang", "n", "words", "counts", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _TASK_BITS
        held: dict[str, tuple[_Words, list[np.ndarray]]] = {}

        def closed(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal number
            words, parts = held.pop(lang)
            listed = np.empty(len(words), dtype=object)
            listed[:] = list(words)
            for codes in _in_pieces(np.concatenate(parts), block):
                yield row(number, lang, listed, codes)
                number += len(codes) + 1

        for batch in small(batches):
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for a, b in slices([len(t) for t in texts], SLICE):
                    words, parts = held.setdefault(lang, (_Words(), []))
                    parts += _codes(texts[a:b], words)
                    if sum(map(len, parts)) >= block:
                        yield from closed(lang)
            if len(held) > 100 or sum(len(p) for _, parts in held.values() for p in parts) > 4 * block:
                for lang in list(held):
                    yield from closed(lang)
        for lang in list(held):
            yield from closed(lang)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(text, lang).mapInArrow(
        run, "block long, lang string, n long, words array<binary>, counts array<long>, codes binary"
    )


def _codes(texts: list[bytes], words: _Words, size: int = SLICE) -> list[np.ndarray]:
    """Codes of the words of all texts, with a 0 between pieces and after each text."""
    whole = b".".join([*texts, b""]).translate(_PLAIN)
    found, start = [], 0
    while start < len(whole):
        end = start + size
        if end < len(whole):  # a piece end or a space, where no word goes on
            near = max(whole.rfind(b" ", start, end), whole.rfind(b".", start, end))
            end = near + 1 if near >= start else 1 + min(k for k in (whole.find(b" ", end), whole.find(b".", end)) if k >= 0)
        tokens = whole[start:end].replace(b".", b" . ").split(b" ")
        codes = np.fromiter(map(words.__getitem__, filter(None, tokens)), dtype=np.int32)
        found.append(codes[(codes > 0) | np.append(True, codes[:-1] > 0)])
        start = end
    return found


def _in_pieces(codes: np.ndarray, block: int) -> Iterator[np.ndarray]:
    """The codes in blocks that end with pieces; the last code is the end of one."""
    while len(codes) > block + block // 2:
        ends = np.flatnonzero(codes[:block] == 0)
        end = ends[-1] if len(ends) and ends[-1] else block + np.argmax(codes[block:] == 0)
        yield codes[: end + 1]
        codes = codes[end + 1 :]
    if len(codes):
        yield codes


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed numbers, all first bytes first: the high ones are mostly zero."""
    planes = np.ascontiguousarray(numbers, dtype=np.int64).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def _packed_codes(codes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(codes.astype(np.int32).tobytes())


def _unpacked_codes(codes: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(codes), dtype=np.int32)


def _joined(held: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Merge-join of a relation with itself at the next position.

    The positions where two phrases follow each other, and their codes as one
    number: left code times the last result, plus right code.
    """
    at = np.flatnonzero((held[:-1] > 0) & (held[1:] > 0))
    width = int(held.max(initial=0)) + 1
    return at, held[at].astype(np.int64) * width + held[at + 1], width


def _hashes(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.int64)


def _bounds(sharded: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """Each shard of an ascending array, with its first entry and the one after its last."""
    ends = np.searchsorted(sharded, np.arange(shards + 1))
    for shard in np.flatnonzero(ends[:-1] < ends[1:]):
        yield int(shard), int(ends[shard]), int(ends[shard + 1])


def _listed(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct words of each block with their counts, in one row for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("block", "lang", "words", "counts"))):
                block, lang, words, counts = row[0].as_py(), row[1].as_py(), row[2].as_py(), row[3].values.to_numpy()
                made = [
                    (shard, block, a + 1, lang, zstandard.compress(b" ".join(words[a:b]), 1), _packed(counts[a:b]))
                    for shard, a, b in _bounds(_hashes(words) * shards >> 32, shards)
                ]
                if made:
                    yield _batch(made, shard=pa.int32(), block=None, place=pa.int32(), lang=None, words=None, n=None)

    return run


def _batch(rows: list[tuple], **types: pa.DataType | None) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))


def _candidates(codes: np.ndarray, ids: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """The distinct phrases of one word more in a block, by shard and then by their codes.

    The positions at which they begin, which of them does (from 0), and of each
    its shard, the ids of its parts and its count.
    """
    at, pairs, width = _joined(codes)
    pairs, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    left, right = ids[pairs // width - 1], ids[pairs % width - 1]
    mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    shard = ((mixed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order))
    return at, place[which], shard[order], left[order], right[order], counts[order]


def _counted(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct phrases of one word more in each block with their counts, in one row for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, ids in zip(*(batch.column(c) for c in ("block", "codes", "ids"))):
                _, _, shard, left, right, n = _candidates(_unpacked_codes(codes.as_py()), _unpacked(ids.as_py()), shards)
                made = [
                    (s, block.as_py(), a + 1, _packed(np.concatenate([np.diff(left[a:b], prepend=0), right[a:b], n[a:b]])))
                    for s, a, b in _bounds(shard, shards)
                ]
                if made:
                    yield _batch(made, shard=pa.int32(), block=None, place=pa.int32(), pairs=None)

    return run


def _semi_join(held: DataFrame, common: DataFrame, shards: int) -> DataFrame:
    """The next relation: the candidates that ``held`` extends to, where they are frequent.

    ``(block, codes, ids)``: code c stands for the phrase ``ids[c - 1]``. The first
    relation has no ids: its codes are the words themselves.
    """

    def keep(relation: pa.Table, frequent: pa.Table) -> pa.Table:
        if relation.num_rows == 0 or frequent.num_rows == 0:
            return relation.slice(0, 0)
        (row,) = relation.to_pylist()
        begins = _unpacked_codes(row["codes"])
        if row["ids"] is not None:
            at, place, *_ = _candidates(begins, _unpacked(row["ids"]), shards)
            begins = np.zeros(len(begins), dtype=np.int32)
            begins[at] = place + 1
        places, ids = (np.concatenate([_unpacked(p) for p in frequent.column(c).to_pylist()]) for c in ("places", "ids"))
        order = np.argsort(ids)
        codes = np.zeros(int(begins.max(initial=0)) + 1, dtype=np.int32)
        codes[places[order]] = np.arange(1, len(places) + 1)
        made = [pa.array([row["block"]]), pa.array([_packed_codes(codes[begins])]), pa.array([_packed(ids[order])])]
        return pa.table(made, schema=relation.schema)

    blocks = held.groupBy("block").cogroup(common.where("block IS NOT NULL").select("block", "places", "ids").groupBy("block"))
    return blocks.applyInArrow(keep, "block long, codes binary, ids binary")
