"""SentencePiece models run by the tokenizers library: encoding, decoding, and proof that both agree.

The model file is parsed and rebuilt as a tokenizer: its normaliser (character
map, extra white space, leading space), the metaspace marker for spaces, its
pieces with unigram scores, or merges ranked by score for BPE models, and byte
fallback. A token cannot cross two neighbouring characters that no piece has
side by side. Normalised texts are cut at such places: before markers, between
letters and points, around line ends, as far as the model's pieces allow it. Each
distinct part is encoded and decoded once (``chunk_memo``), in batches that the
library spreads over threads; each is also encoded by the sentencepiece library,
and ids and texts are compared. Where a normaliser does more than put markers for
spaces, whole raw texts are encoded by the untouched model too.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coldshelf.llm.chunk_memo import HashedMemo
from coldshelf.llm.shared import each_batch, slices

MARK = "▁"
OTHER_IDS, OTHER_TEXT = 1, 2
SLICE = 1 << 20
# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def parse(path: str):
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        return sentencepiece_model_pb2.ModelProto.FromString(file.read())


def _merges(proto) -> list[tuple[str, str]]:
    """Pairs of pieces that make another piece, best score first; of one piece the earlier left parts first."""
    ranks = {p.piece: (-p.score, i) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
    found = []
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ranks and right in ranks:
                found.append((rank, ranks[left], ranks[right], (left, right)))
    return [pair for *_, pair in sorted(found)]


def _normalizer(spec):
    from tokenizers import Regex, normalizers

    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def _cuts(pieces: list[str], fallback: bool) -> Callable[[np.ndarray], np.ndarray]:
    """A function that marks where a normalised text, as UTF-8 bytes, is cut: where no piece can cross.

    Without byte fallback, neighbouring characters that have no piece become
    one unknown token, so texts are cut before markers only.
    """
    joined = [p for p in pieces if len(p) > 1]
    at_markers = not any(MARK in p.lstrip(MARK) for p in joined)
    letter = "[A-Za-zÀ-ÖØ-öø-ÿ]"
    points = [ord(m) for m in ".,!|" if fallback and not any(re.search(letter + re.escape(m), p) for p in joined)]
    at_lines = fallback and not any("\n" in p for p in joined)

    def shifted(data: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([np.zeros(by, dtype=data.dtype), data[:-by]])[: len(data)]

    def cuts(data: np.ndarray) -> np.ndarray:
        found = np.zeros(len(data), dtype=bool)
        if len(data) < 4:
            data = np.append(data, np.zeros(4, dtype=np.uint8))
            return cuts(data)[: len(found)]
        before = shifted(data, 1)
        if at_markers:
            marker = np.zeros(len(data), dtype=bool)
            marker[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            found |= marker & ~shifted(marker, 3)
        if points:
            two_before = shifted(data, 2)
            small = before | 0x20
            # Two bytes from C3 on are a letter, but for the signs of multiplication and division.
            latin = (two_before == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
            found |= (((small >= 97) & (small <= 122) & (before < 0x80)) | latin) & np.isin(data, points)
        if at_lines:
            found |= (data == 10) != (before == 10)
        return found

    return cuts


class PieceTokenizer:
    """A rebuilt model. ``threads`` is how many threads the library may use in one Python worker."""

    def __init__(self, path: str, threads: int = 2) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, decoders, models

        proto = parse(path)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        vocabulary = [(p.piece, p.score) for p in proto.pieces]
        fallback = trainer.byte_fallback
        if trainer.model_type == UNIGRAM:
            model = models.Unigram(vocabulary, trainer.unk_id, fallback)
        elif trainer.model_type == BPE:
            ids = {piece: i for i, (piece, _) in enumerate(vocabulary)}
            unknown = vocabulary[trainer.unk_id][0]
            model = models.BPE(ids, _merges(proto), unk_token=unknown, fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError(f"model type {trainer.model_type} is neither unigram nor BPE")
        self.tokenizer = Tokenizer(model)
        self.normalizer = _normalizer(spec)
        self._prefix = spec.add_dummy_prefix
        # Where only spaces are marked, a plain replacement gives the same.
        self._marks_only = spec.escape_whitespaces and not (spec.precompiled_charsmap or spec.remove_extra_whitespaces)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        # Of parts nothing is stripped: the space of the marker before a text is the first part's.
        self._part_decoder = decoders.Sequence(steps)
        self._decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * self._prefix)
        self._whole = None if self._marks_only else SentencePieceProcessor(model_file=path)
        # The same model without a normaliser: it is given parts that are normalised already.
        spec.Clear()
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        spec.escape_whitespaces = True
        self._plain = SentencePieceProcessor(model_proto=proto.SerializeToString())
        # Bytes that stand for characters without a piece are not texts.
        cut = _cuts([p.piece for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)], fallback)
        self._memo = HashedMemo(cut, self._encode_parts, check=self._faults)

    def _encode_parts(self, parts: list[str]) -> Iterator[list[int]]:
        for i in range(0, len(parts), 10_000):
            some = parts[i : i + 10_000]
            yield from [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _faults(self, parts: list[str], ids: list[list[int]]) -> Iterator[int]:
        """For each part the bits ``OTHER_IDS`` and ``OTHER_TEXT``."""
        self.tokenizer.decoder = self._part_decoder
        for i in range(0, len(parts), 10_000):
            some, made = parts[i : i + 10_000], ids[i : i + 10_000]
            back = self.tokenizer.decode_batch(made, skip_special_tokens=False)
            for part, own, other, text in zip(some, made, self._plain.encode(some, num_threads=1), back):
                yield OTHER_IDS * (own != other) | OTHER_TEXT * (text != part.replace(MARK, " "))

    def normalize(self, text: str | None) -> str:
        """Null is empty, and an empty text stays so."""
        if text and self._marks_only:
            return MARK * self._prefix + text.replace(" ", MARK)
        return self.normalizer.normalize_str(text) if text else ""

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in one array, their number by text, whether sentencepiece gives the same, and whether they decode.

        A text decodes if each of its parts does, as decoding joins what its parts decode to.
        """
        ids, sizes, faults = self._memo.checked([self.normalize(t) for t in texts])
        parity = (faults & OTHER_IDS) == 0
        if self._whole is not None:
            others = self._whole.encode([t or "" for t in texts], num_threads=1)
            ends = np.cumsum(sizes)
            parity &= [ids[e - n : e].tolist() == o for e, n, o in zip(ends, sizes, others)]
        return ids, sizes, parity, (faults & OTHER_TEXT) == 0

    def decode(self, lists: list[list[int]]) -> list[str]:
        self.tokenizer.decoder = self._decoder
        return self.tokenizer.decode_batch(lists, skip_special_tokens=False)

    def restored(self, normalized: str) -> str:
        """What decoding has to give: the normalised text with spaces for markers."""
        made = normalized.replace(MARK, " ")
        return made[1:] if self._prefix else made


_loaded: dict[tuple[str, int], PieceTokenizer] = {}


def tokenizer_of(path: str, threads: int) -> PieceTokenizer:
    """One for each Python worker."""
    if (path, threads) not in _loaded:
        _loaded[path, threads] = PieceTokenizer(path, threads)
    return _loaded[path, threads]


def encoded(docs: DataFrame, model_path: str, threads: int = 2) -> DataFrame:
    """``(doc_id, n_tokens, ids, parity, round_trip)``, one row per row of ``documents``.

    ``parity``: the sentencepiece library gives the same ids, for each part of
    the text, and for the whole raw text where a normaliser does more than mark
    spaces. ``round_trip``: the ids decode to the normalised text. A null or
    empty text has no ids, and both hold.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer = tokenizer_of(model_path, threads)
        texts = batch.column("text").to_pylist()
        ids, sizes, parity, back = [], [], [], []
        for a, b in slices([len(t or "") for t in texts], SLICE):
            flat, counts, same, decoded = tokenizer.encode(texts[a:b])
            ids.append(flat.astype(np.int32))
            sizes.append(counts)
            parity.append(same)
            back.append(decoded)
        counts = np.concatenate(sizes)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        arrays = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))
        columns = [batch.column("doc_id"), pa.array(counts), arrays, pa.array(np.concatenate(parity)), pa.array(np.concatenate(back))]
        return pa.record_batch(columns, names=["doc_id", "n_tokens", "ids", "parity", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        each_batch(make), "doc_id long, n_tokens long, ids array<int>, parity boolean, round_trip boolean"
    )
