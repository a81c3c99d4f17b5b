"""Token ids of many texts, with each distinct piece of text encoded, and checked, only once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np

from coldshelf.llm.rolling import stretch_hashes


class HashedMemo:
    """Cuts texts where no token can cross, and remembers the ids of each piece.

    ``cuts`` marks the UTF-8 bytes at which pieces begin. It must cut only where
    no token can cross, and a piece's ids must not depend on what stands around
    it. All pieces of a call are looked up at once. The memory is bounded: it is
    emptied when it holds ``limit`` pieces, which changes the time taken and
    nothing else. A 64-bit hash only finds a
    piece: its bytes are kept and compared at every use. A piece whose hash
    belongs to other bytes is encoded by itself, each time it comes.
    """

    def __init__(
        self,
        cuts: Callable[[np.ndarray], np.ndarray],
        encode: Callable[[list[str]], Iterable[list[int]]],
        limit: int = 1_500_000,
        check: Callable[[list[str], list[list[int]]], Iterable[int]] | None = None,
    ) -> None:
        self._cuts, self._encode, self._limit, self._check = cuts, encode, limit, check
        self._bits = int(2 * limit).bit_length()
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(1 << self._bits, dtype=np.uint64)  # 0: free
        self._numbers = np.zeros(1 << self._bits, dtype=np.int32)
        self._pool = np.empty(0, dtype=np.uint32)
        self._ends = np.zeros(1, dtype=np.int64)
        self._bytes = np.empty(0, dtype=np.uint8)
        self._byte_ends = np.zeros(1, dtype=np.int64)
        self._faults = np.empty(0, dtype=np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many belong to each text."""
        return self.checked(texts)[:2]

    def checked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, and for each text the faults (bits) that ``check`` found in any of its pieces."""
        if len(self._ends) > self._limit or len(self._bytes) > 32 * self._limit:
            self._forget()
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        whole = b"".join(coded)
        data = np.frombuffer(whole, dtype=np.uint8)
        text_ends = np.cumsum([0, *map(len, coded)], dtype=np.int64)
        begins = self._cuts(data)
        begins[text_ends[:-1][np.diff(text_ends) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes = np.maximum(stretch_hashes(data, starts, ends), np.uint64(1))
        at = self._find(hashes)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            fresh, first = np.unique(hashes[unknown], return_index=True)
            self._enter_all(fresh, self._learn(whole, starts[unknown[first]], ends[unknown[first]]))
            at[unknown] = self._find(hashes[unknown])
        other = self._differing(data, starts, ends, at)
        if len(other):
            at[other] = self._learn(whole, starts[other], ends[other])
        sizes = self._ends[at + 1] - self._ends[at]
        borders = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(borders[-1]) + np.repeat(self._ends[at] - borders[:-1], sizes)
        begin = np.searchsorted(starts, text_ends)
        faults = np.zeros(len(texts), dtype=np.uint8)
        if self._faults.any():
            found = self._faults[at]
            faulty = np.flatnonzero(found)
            np.bitwise_or.at(faults, np.searchsorted(begin, faulty, side="right") - 1, found[faulty])
        return self._pool[places], np.diff(borders[begin]), faults

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is not known."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        slot, left = self._slots(hashes), np.arange(len(hashes))
        while len(left):
            there = self._keys[slot]
            hit = there == hashes[left]
            found[left[hit]] = self._numbers[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self._keys) - 1)
        return found

    def _differing(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which pieces have other bytes than those kept under the numbers ``at``; the pieces make up all of ``data``."""
        kept = self._byte_ends[at]
        wrong = self._byte_ends[at + 1] - kept != ends - starts
        kept[wrong] = 0  # compared with anything: wrong as it is
        places = np.arange(len(data)) + np.repeat(kept - starts, ends - starts)
        off = np.flatnonzero(self._bytes.take(places, mode="clip") != data)
        wrong[np.searchsorted(starts, off, side="right") - 1] = True
        return np.flatnonzero(wrong)

    def _learn(self, whole: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Keep the bytes and the ids of the pieces; their numbers."""
        pieces = [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        texts = [p.decode("utf-8", "surrogatepass") for p in pieces]
        ids = list(self._encode(texts))
        faults = np.fromiter(self._check(texts, ids), np.uint8, len(ids)) if self._check else np.zeros(len(ids), np.uint8)
        self._faults = np.concatenate([self._faults, faults])
        numbers = np.arange(len(pieces)) + len(self._ends) - 1
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        added = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum()))
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        self._pool = np.concatenate([self._pool, added])
        self._byte_ends = np.concatenate([self._byte_ends, self._byte_ends[-1] + np.cumsum(ends - starts)])
        self._bytes = np.concatenate([self._bytes, np.frombuffer(b"".join(pieces), dtype=np.uint8)])
        return numbers

    def _enter_all(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Enter distinct hashes that are not known yet."""
        if len(self._ends) > len(self._keys) // 2:  # one call with very many new pieces
            self._bits += 2
            self._rebuild()
        self._enter(hashes, numbers)

    def _enter(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        slot, left = self._slots(hashes), np.arange(len(hashes))
        while len(left):
            free = np.flatnonzero(self._keys[slot] == 0)
            taken, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self._keys[taken], self._numbers[taken] = hashes[left[won]], numbers[left[won]]
            on = np.ones(len(left), dtype=bool)
            on[won] = False
            left, slot = left[on], (slot[on] + 1) & (len(self._keys) - 1)

    def _rebuild(self) -> None:
        """A larger table with the same entries."""
        used = np.flatnonzero(self._keys)
        hashes, numbers = self._keys[used], self._numbers[used]
        self._keys = np.zeros(1 << self._bits, dtype=np.uint64)
        self._numbers = np.zeros(1 << self._bits, dtype=np.int32)
        self._enter(hashes, numbers)
