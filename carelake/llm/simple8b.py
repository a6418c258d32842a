"""Simple-8b: integers packed word-aligned into 64-bit words.

The top 4 bits of a word select how many values of how many bits its other 60 bits hold.  Values are
packed in blocks of ``BLOCK``; each block starts a new word and the header holds the word offset of each
block, so blocks are packed and unpacked independently and all at once.  A value of 2^60 or more is an
escape: it is packed as 0 and stands in full, with its position, in a list before the words.

Layout (little-endian): magic ``S8B1``, uint32 block size, uint64 values, uint64 escapes, uint32 word
offset of each block plus the total, uint64 positions of the escapes, uint64 escaped values, uint64 words.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC, BLOCK, HEAD = b"S8B1", 256, struct.Struct("<4sIQQ")
# Fixed values of the format: (values in a word, bits of each) by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
LIMIT = np.uint64(1) << np.uint64(60)


def _widths(v: np.ndarray) -> np.ndarray:
    """Bits that each value below 2^60 needs (near 2^53 and above perhaps one more, 60 at most)."""
    return np.minimum(np.frexp(v.astype(np.float64))[1], 60).astype(np.uint8)


def _selectors(width: np.ndarray) -> np.ndarray:
    """For each position (rows: blocks) the lowest selector that fits the values from there on; past the end nothing needs bits.

    Where a selector does not fit, no lower one does: it would hold more values of fewer bits.
    """
    rows, size = width.shape
    best = np.full((rows, size), 15, dtype=np.uint8)
    most, power = width, 1  # widest of the next ``power`` values
    for sel in range(14, -1, -1):
        c = int(COUNTS[sel])
        while power * 2 <= c:
            x = most.copy()
            np.maximum(most[:, : size - power], most[:, power:], out=x[:, : size - power])
            most, power = x, power * 2
        rest = c - power  # the window of c values is two overlapping ones of ``power``
        bits = np.uint8(BITS[sel])  # of the widths' own type, so that they are compared as they are
        fits = most <= bits
        if rest:
            fits[:, : size - rest] &= most[:, rest:] <= bits
        if not fits.any():
            break
        best -= fits.view(np.uint8)
    return best


def pack(values: np.ndarray) -> bytes:
    """Values (unsigned 64-bit) as the bytes of the format."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    at = np.flatnonzero(v >= LIMIT).astype(np.uint64)
    escaped = v[at.astype(np.int64)]
    if len(at):
        v = v.copy()
        v[at.astype(np.int64)] = 0
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, dtype=np.uint64)
    grid[:n] = v
    sel = _selectors(_widths(grid).reshape(blocks, BLOCK)) if blocks else np.zeros((0, BLOCK), np.uint8)
    flat, begins = sel.reshape(-1), []
    at_word = np.arange(blocks) * BLOCK
    stop = np.minimum(at_word + BLOCK, n)
    while len(at_word):  # the next word of each block that is not at its end
        begins.append(at_word)
        at_word = at_word + COUNTS[flat[at_word]]
        live = at_word < stop
        if not live.all():
            at_word, stop = at_word[live], stop[live]
    firsts = np.sort(np.concatenate(begins)) if begins else np.zeros(0, np.int64)
    s, block = flat[firsts].astype(np.int64), firsts // BLOCK
    in_block = np.bincount(block, minlength=blocks)
    words = s.astype(np.uint64) << np.uint64(60)
    kinds = np.flatnonzero(np.bincount(s, minlength=16))
    pad = int(COUNTS[kinds].max()) if len(kinds) else 0  # a block's last word may reach past its end, into zeros
    wide = np.zeros((blocks, BLOCK + pad), np.uint64)
    wide[:, :BLOCK] = grid.reshape(blocks, BLOCK)
    wide, start = wide.reshape(-1), firsts + block * pad
    for k in kinds:
        if BITS[k]:
            own = np.flatnonzero(s == k)
            begin = start[own]
            acc = wide[begin]
            for j in range(1, int(COUNTS[k])):
                acc |= wide[begin + j] << np.uint64(j * int(BITS[k]))
            words[own] |= acc
    offsets = np.concatenate([[0], np.cumsum(in_block)]).astype("<u4")
    return b"".join((HEAD.pack(MAGIC, BLOCK, n, len(at)), offsets.tobytes(), at.astype("<u8").tobytes(), escaped.astype("<u8").tobytes(), words.astype("<u8").tobytes()))


def unpack(data: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The values of all blocks, or of blocks ``first_block`` up to ``last_block`` alone."""
    magic, size, n, escapes = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b section")
    blocks = -(-n // size)
    last = blocks if last_block is None else min(last_block, blocks)
    at = HEAD.size
    offsets = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
    at += 4 * (blocks + 1)
    where = np.frombuffer(data, "<u8", escapes, at).astype(np.int64)
    full = np.frombuffer(data, "<u8", escapes, at + 8 * escapes)
    at += 16 * escapes
    if first_block >= last:
        return np.zeros(0, np.uint64)
    lo, hi = offsets[first_block], offsets[last]
    words = np.frombuffer(data, "<u8", hi - lo, at + 8 * lo)
    s = (words >> np.uint64(60)).astype(np.int64)
    block = np.repeat(np.arange(first_block, last), np.diff(offsets[first_block : last + 1]))
    taken = np.cumsum(COUNTS[s]) - COUNTS[s]
    opens = np.searchsorted(block, np.arange(first_block, last))
    first = taken - taken[opens][block - first_block]
    total = min(last * size, n) - first_block * size
    kinds = np.flatnonzero(np.bincount(s, minlength=16))
    pad = int(COUNTS[kinds].max())
    wide = np.zeros((last - first_block) * (size + pad), dtype=np.uint64)
    start = first + (block - first_block) * (size + pad)
    for k in kinds:
        if BITS[k]:
            own = np.flatnonzero(s == k)
            begin, held, mask = start[own], words[own], (np.uint64(1) << np.uint64(BITS[k])) - np.uint64(1)
            for j in range(int(COUNTS[k])):
                wide[begin + j] = (held >> np.uint64(j * int(BITS[k]))) & mask
    out = np.ascontiguousarray(wide.reshape(last - first_block, size + pad)[:, :size]).reshape(-1)[:total]
    inside = (where >= first_block * size) & (where < first_block * size + total)
    out[where[inside] - first_block * size] = full[inside]
    return out
