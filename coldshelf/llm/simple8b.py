"""Simple-8b: whole numbers packed into 64-bit words, each with a selector and as many numbers as fit.

A word's upper four bits select how its other 60 bits are divided; see
``WIDTHS``. Selector 0 is an escape for numbers of over 60 bits: the word holds
a place in a list of raw numbers. Numbers are coded in blocks of ``BLOCK``, and
a block begins a new word, so blocks can be decoded alone, and all at once.

Layout of a coded list, little-endian: four unsigned 32-bit counts (numbers,
blocks, words, escapes), the first word of each block (32 bits each, padded to
eight bytes), the words, and the escaped numbers (64 bits each).
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
# Fixed values of the code: bits per number by selector 1, 2, ...; a word holds 60 // width of them.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = 60 // WIDTHS
ESCAPE = len(WIDTHS)
_LIMITS = (np.uint64(1) << WIDTHS.astype(np.uint64)) - np.uint64(1)
_MOST = int(COUNTS.max())


def encode(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Codes lists of numbers: ``values`` holds the lists one after the other, ``sizes`` their lengths."""
    values, sizes = np.asarray(values, dtype=np.uint64), np.asarray(sizes, dtype=np.int64)
    blocks = -(-sizes // BLOCK)
    of_list = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(of_list)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    filled = np.minimum(BLOCK, sizes[of_list] - nth * BLOCK)
    grid = np.zeros((len(of_list), BLOCK + _MOST), dtype=np.uint64)
    grid[:, :BLOCK][np.arange(BLOCK) < filled[:, None]] = values
    row, pos, sel = _words(grid, filled)

    words = np.zeros(len(row), dtype=np.uint64)
    for s, (width, count) in enumerate(zip(WIDTHS.tolist(), COUNTS.tolist())):
        i = np.flatnonzero(sel == s)
        word = np.full(len(i), (s + 1) << 60, dtype=np.uint64)
        for j in range(count):
            word |= grid[row[i], pos[i] + j] << np.uint64(j * width)
        words[i] = word
    escaped = np.flatnonzero(sel == ESCAPE)
    escape_list = of_list[row[escaped]]
    raw = grid[row[escaped], pos[escaped]]

    n_lists = len(sizes)
    word_ends = np.cumsum(np.bincount(of_list[row], minlength=n_lists))
    escape_ends = np.cumsum(np.bincount(escape_list, minlength=n_lists))
    words[escaped] = (np.arange(len(escaped)) - (escape_ends - np.bincount(escape_list, minlength=n_lists))[escape_list])
    per_block = np.bincount(row, minlength=len(of_list))
    first = np.cumsum(per_block) - per_block
    coded, word_at, block_at, escape_at = [], 0, 0, 0
    for k in range(n_lists):
        n_words, n_blocks, n_escapes = word_ends[k] - word_at, blocks[k], escape_ends[k] - escape_at
        head = np.array([sizes[k], n_blocks, n_words, n_escapes], dtype="<u4").tobytes()
        begins = (first[block_at : block_at + n_blocks] - word_at).astype("<u4")
        if n_blocks % 2:
            begins = np.append(begins, np.uint32(0)).astype("<u4")
        body = words[word_at : word_ends[k]].astype("<u8").tobytes()
        coded.append(head + begins.tobytes() + body + raw[escape_at : escape_ends[k]].astype("<u8").tobytes())
        word_at, block_at, escape_at = word_ends[k], block_at + n_blocks, escape_ends[k]
    return coded


def _words(grid: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, first place and width class of each word, in order; as many numbers as fit go into each."""
    need = np.searchsorted(_LIMITS, grid.ravel(), side="left").astype(np.uint8).reshape(grid.shape)
    best = np.minimum(need, ESCAPE)[:, :BLOCK].copy()
    best[best < ESCAPE] = ESCAPE - 1
    most, n = need, 1
    for s in range(ESCAPE - 2, -1, -1):  # ever more and narrower numbers
        step = int(COUNTS[s]) - n
        grown = most.copy()
        grown[:, :-step] = np.maximum(most[:, :-step], most[:, step:])
        most, n = grown, int(COUNTS[s])
        best[most[:, :BLOCK] <= s] = s
    counts = np.append(COUNTS, 1)
    rows, places, kinds = [], [], []
    row, pos = np.arange(len(filled)), np.zeros(len(filled), dtype=np.int64)
    while len(row):
        kind = best[row, pos]
        rows.append(row)
        places.append(pos)
        kinds.append(kind)
        pos = pos + counts[kind]
        going = pos < filled[row]
        row, pos = row[going], pos[going]
    if not rows:
        return np.empty(0, int), np.empty(0, int), np.empty(0, np.uint8)
    row, pos, kind = np.concatenate(rows), np.concatenate(places), np.concatenate(kinds)
    order = np.argsort(row * BLOCK + pos, kind="stable")
    return row[order], pos[order], kind[order]


def decode(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists in one array, and the lists' lengths."""
    heads = np.array([np.frombuffer(c, "<u4", 4) for c in coded], dtype=np.int64).reshape(-1, 4)
    sizes, blocks, n_words, n_escapes = heads.T
    if not len(coded):
        return np.empty(0, np.uint64), sizes
    at_words = 16 + 8 * (-(-blocks // 2))
    words = np.concatenate([np.frombuffer(c, "<u8", n, a) for c, n, a in zip(coded, n_words.tolist(), at_words.tolist())])
    raw = np.concatenate(
        [np.frombuffer(c, "<u8", n, a) for c, n, a in zip(coded, n_escapes.tolist(), (at_words + 8 * n_words).tolist())]
    )
    word_from = np.cumsum(n_words) - n_words
    firsts = np.concatenate([np.frombuffer(c, "<u4", n, 16) for c, n in zip(coded, blocks.tolist())]).astype(np.int64)
    of_list = np.repeat(np.arange(len(sizes)), blocks)
    firsts = firsts + word_from[of_list]
    nth = np.arange(len(of_list)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    out_from = (np.cumsum(sizes) - sizes)[of_list] + nth * BLOCK
    out_to = out_from + np.minimum(BLOCK, sizes[of_list] - nth * BLOCK)

    kind = (words >> np.uint64(60)).astype(np.int64) - 1
    counts = np.append(COUNTS, 1)[kind]  # kind -1, the escape, is last
    before = np.cumsum(counts) - counts
    block = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(words))))
    start = out_from[block] + before - before[firsts][block]
    out = np.zeros(int(sizes.sum()), dtype=np.uint64)
    for s, (width, count) in enumerate(zip(WIDTHS.tolist(), COUNTS.tolist())):
        i = np.flatnonzero(kind == s)
        mask = np.uint64((1 << width) - 1)
        for j in range(count):
            k = i[start[i] + j < out_to[block[i]]]
            out[start[k] + j] = words[k] >> np.uint64(j * width) & mask
    i = np.flatnonzero(kind == -1)
    escape_from = np.cumsum(n_escapes) - n_escapes
    out[start[i]] = raw[escape_from[of_list[block[i]]] + words[i].astype(np.int64)]
    return out, sizes
