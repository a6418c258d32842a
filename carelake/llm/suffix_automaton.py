"""Suffix automata of symbol strings as one dense table, for greedy cross-parsing in lockstep.

The automaton of a text has a path for each of its substrings and at most two states a symbol.  Cross-parsing
cuts another text into phrases, each the longest match that starts where the last one ended.  In the table a
missing transition already holds what follows it: the state that the symbol starts a new phrase with, and a flag.
"""

from __future__ import annotations

from array import array

import numpy as np

NEW = np.int32(1 << 30)  # flag of a transition that begins a new phrase


def automaton(symbols: bytes, width: int) -> np.ndarray:
    """Transitions (states x ``width``) of the suffix automaton of ``symbols``, -1 where there is none; state 0 is the start."""
    most = 2 * len(symbols) + 2
    step, length, link = array("i", [-1]) * (most * width), [0] * most, [-1] * most
    last, size = 0, 1
    for c in symbols:
        cur, size = size, size + 1
        length[cur] = length[last] + 1
        p = last
        while p >= 0 and step[p * width + c] < 0:
            step[p * width + c] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = step[p * width + c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone, size = size, size + 1
                length[clone], link[clone] = length[p] + 1, link[q]
                step[clone * width : (clone + 1) * width] = step[q * width : (q + 1) * width]
                while p >= 0 and step[p * width + c] == q:
                    step[p * width + c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return np.frombuffer(step, np.int32)[: size * width].reshape(size, width)


class Parsers:
    """The automata of several texts in one table."""

    def __init__(self, texts: list[bytes], width: int) -> None:
        parts, self.starts, base = [], [], 0
        for text in texts:
            t = automaton(text, width)
            # No symbol leads to the start: a string begins there, or one that the text lacks, a phrase of its own, has just
            # been met.  So whatever leaves it begins a phrase.
            first = np.where(t[0] >= 0, t[0], 0) + base | NEW
            part = np.where(t >= 0, t + base, first).astype(np.int32)
            part[0] = first
            parts.append(part)
            self.starts.append(base)
            base += len(t)
        if base >= NEW:
            raise ValueError("the reference texts are too long for one table")
        self.width, self.table = width, np.concatenate([p.reshape(-1) for p in parts])

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of phrases (strings x texts) of each string ``symbols[start : start + size]``.

        All strings advance together, the longest first, so those still running are always the first rows.
        """
        order = np.argsort(-sizes, kind="stable")
        begin, left = starts[order], sizes[order]
        running = len(left) - np.searchsorted(left[::-1], np.arange(int(left[0]) if len(left) else 0), "right")
        root = np.array(self.starts, np.int64) * self.width
        at = np.broadcast_to(root, (len(left), len(root))).copy()
        count = np.zeros(at.shape, np.int32)
        for i, n in enumerate(running.tolist()):
            got = self.table.take(at[:n] + symbols.take(begin[:n] + i)[:, None])
            count[:n] += got >> 30
            at[:n] = (got & (NEW - 1)).astype(np.int64) * self.width
        out = np.zeros(at.shape, np.int64)
        out[order] = count
        return out
