"""Exact nearest examples by cosine, over an inverted index with block maxima.

Examples are put in an order that brings like ones together and cut into blocks of ``BLOCK``, and these into segments of
``SEGMENT``.  A term that many examples of a segment hold is kept there as a row of a matrix; the rest of its postings follow
the order of the examples, and of each term that more than a few examples hold, the start of every block in these postings and
the largest weight in every block are stored.  A search multiplies a batch of queries by the matrices, each by the rows that
some query of the batch needs, and reads the postings of the rare terms, which weigh most.  What it has by then is a lower bound
of each similarity, so the k-th best is a threshold; and a block whose best example could not reach it even with the stored
maxima of all other terms is skipped: no posting of it is read any more.  The middle terms are then read for the blocks that are
left, and the best are summed again from their own terms in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 128  # examples of a block
CELL = 16  # examples of a cell, far apart in the order, whose largest values set the threshold
GAP = 8  # blocks from one that is needed to the next up to which all are read
SEGMENT = 8 * BLOCK  # examples that share a matrix
DENSE = 0.002  # share of all examples times that of a segment's from which on a term is in the segment's matrix
MOST = 0.7  # share of a matrix's rows from which on it is used as a whole
RARE, LEAST = 0.004, 32  # share of the examples, and their number, up to which a term is rare


class BlockMaxIndex:
    """Vectors by example and by term.

    ``starts, term, count``: the sorted terms of each example and how often it holds each; a weight is
    (1 + log count) * ``idf``, over the length of the example's vector.
    """

    def __init__(self, starts: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> None:
        n, n_terms = len(starts) - 1, len(idf)
        self.n, self.idf = n, idf.astype(float)
        self.log = np.log(np.arange(int(count.max(initial=0)) + 1).clip(1)) + 1.0
        self.log[0] = 0.0
        self.blocks = -(-n // BLOCK)
        self.width = self.blocks * BLOCK
        value, self.length, rest = np.zeros(len(term), np.float32), np.zeros(n), np.ones(len(term), bool)
        df = np.bincount(term, minlength=n_terms)
        matrices = []  # of each segment: the terms of its matrix, and the matrix
        for lo in range(0, n, SEGMENT):  # segment by segment, as the whole in double precision is far larger than the index
            hi = min(lo + SEGMENT, n)
            a, b = int(starts[lo]), int(starts[hi])
            size, own = np.diff(starts[lo : hi + 1]), term[a:b]
            v = self.log[count[a:b]] * self.idf[own]
            row = np.repeat(np.arange(hi - lo), size)
            self.length[lo:hi] = np.sqrt(np.bincount(row, v * v, hi - lo))
            value[a:b] = v / np.repeat(self.length[lo:hi], size)
            held = np.bincount(own, minlength=n_terms)
            chosen = np.flatnonzero((held > LEAST) & (held * df > DENSE * (hi - lo) * n))
            column = np.full(n_terms, -1, np.int32)
            column[chosen] = np.arange(len(chosen))
            at = column[own]
            rest[a:b] = at < 0
            inside = np.flatnonzero(at >= 0)
            matrix = np.zeros((len(chosen), hi - lo), np.float32)
            matrix[at[inside], row[inside]] = self.log[count[a:b][inside]]
            matrices.append((chosen, matrix))
        dense = np.unique(np.concatenate([c for c, _ in matrices] or [np.zeros(0, np.int64)]))
        self.dense_place = np.full(n_terms, -1, np.int32)
        self.dense_place[dense] = np.arange(len(dense))
        # the matrices in one stretch, zeros after them; and where in it each segment's row of a term begins (of others: the zeros)
        self.values = np.concatenate([*(m.ravel() for _, m in matrices), np.zeros(SEGMENT, np.float32)])
        self.row_begin = np.full((len(matrices), len(dense)), len(self.values) - SEGMENT)
        self.matrices, begin = [], 0
        for k, (chosen, matrix) in enumerate(matrices):
            at = self.dense_place[chosen]
            self.row_begin[k, at] = begin + np.arange(len(chosen)) * matrix.shape[1]
            self.matrices.append((at, self.values[begin : begin + matrix.size].reshape(matrix.shape)))
            begin += matrix.size
        del matrices
        kept = np.flatnonzero(rest).astype(np.int32 if len(term) < 1 << 31 else np.int64)
        kept = kept[np.argsort(term[kept], kind="stable")]
        by_term, self.counts = term[kept], count[kept]
        left = np.bincount(by_term, minlength=n_terms)
        self.first = np.concatenate([[0], np.cumsum(left)])
        self.postings = np.zeros(len(kept), np.int64)  # example and weight of one in a number, so that a stretch is copied at once
        row, weight = self.postings.view(np.int32)[::2], self.postings.view(np.float32)[1::2]
        weight[:] = value[kept]
        del value
        row[:] = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))[kept]
        del kept
        rare = df <= max(RARE * n, LEAST)
        self.middle = ~rare & (left > 0)
        self.rare = rare & (left > 0)
        stored = np.flatnonzero(self.middle)
        self.place = np.full(n_terms, -1, np.int32)
        self.place[stored] = np.arange(len(stored))
        own = np.flatnonzero(self.middle[by_term])
        cell = self.place[by_term[own]].astype(np.int64) * self.blocks + row[own] // BLOCK
        largest = np.zeros(len(stored) * self.blocks, np.float32)
        np.maximum.at(largest, cell, weight[own])
        self.largest = largest.reshape(len(stored), self.blocks)
        self.begin = np.zeros((len(stored), self.blocks + 1), np.int32 if len(term) < 1 << 31 else np.int64)
        np.cumsum(np.bincount(cell, minlength=len(largest)).reshape(self.largest.shape), axis=1, out=self.begin[:, 1:])
        self.begin += self.first[stored].astype(self.begin.dtype)[:, None]
        # what rounding to single precision can move a similarity by
        self.slack = 1e-5
        self.mark, self.asked = np.zeros(n, bool), np.zeros(n, np.int32)
        self.scale = np.zeros(self.width, np.float32)
        np.divide(1.0, self.length, out=self.scale[:n], where=self.length > 0)
        self.met = self.skipped = 0

    def _read(self, own: np.ndarray, begin: np.ndarray, end: np.ndarray, weight: np.ndarray, read: list) -> tuple[np.ndarray, np.ndarray]:
        """The examples of these stretches of postings, and their weights times that of the term.  Notes in ``read`` which of the
        query's terms they are of (``own``), where each ends, the postings, and the examples."""
        size = end - begin
        stop = np.cumsum(size)
        at = np.repeat(begin - stop + size, size)
        at += np.arange(len(at))
        found = self.postings.take(at)
        rows = found.view(np.int32)[::2].astype(np.intp)
        read.append((own, stop, at, rows))
        return rows, found.view(np.float32)[1::2] * np.repeat(weight.astype(np.float32), size)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the k examples of largest similarity above 0 (ties: the first places), but ``without``.

        The query's vector has length 1; similarities are rounded to 9 digits.
        """
        return next(self.nearest_of([(terms, weights)], k, [without]))[:2]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> Iterator[tuple[np.ndarray, ...]]:
        """The same for each query, and of the terms that its nearest share with it: the place among them, the term, and the
        part of the similarity that the term makes.  Queries that share terms are best asked together."""
        for (t, _), (at, sims, parts) in zip(queries, self.search(queries, k, without), strict=True):
            of, shared = np.nonzero(parts)
            yield at, sims, of, t[shared], parts[of, shared]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for each query, with the part of each similarity (rows) that each term of the query (columns) makes."""
        near = self._products(queries)
        for q, (t, w) in enumerate(queries):
            if self.n and len(t):
                read: list = []
                yield self._exact(t, w, self._walk(t, w, k, without[q], near[q], read), k, read)
            else:
                yield np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(t)))

    def _products(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the matrices' terms add to the similarity of each query and example."""
        near = np.zeros((len(queries), self.width), np.float32)
        asked = np.zeros((self.row_begin.shape[1], len(queries)), np.float32)
        for q, (t, w) in enumerate(queries):
            at = self.dense_place[t]
            own = np.flatnonzero(at >= 0)
            asked[at[own], q] = w[own] * self.idf[t[own]]
        some = asked.any(axis=1)
        for k, (terms, matrix) in enumerate(self.matrices):
            used = some[terms]
            if np.count_nonzero(used) < MOST * len(used):
                terms, matrix = terms[used], matrix[used]
            if len(terms):
                near[:, k * SEGMENT : k * SEGMENT + matrix.shape[1]] = asked[terms].T @ matrix
        near *= self.scale
        return near

    def _walk(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int, near: np.ndarray, read: list) -> np.ndarray:
        """Add the rare and the middle terms to ``near``; the places of all examples that may be among the k best."""
        at = np.flatnonzero(self.rare[terms])
        if len(at):
            t = terms[at]
            np.add.at(near, *self._read(at, self.first[t], self.first[t + 1], weights[at], read))
        near[self.n :] = -9.0
        if 0 <= without < self.n:
            near[without] = -9.0
        at = np.flatnonzero(self.middle[terms])
        t, w = terms[at], weights[at]
        place = self.place[t]
        # what the middle terms can still add in each block
        top, least = self._top(near, k)
        live = np.flatnonzero(top + w.astype(np.float32) @ self.largest[place] >= least)
        # runs of blocks that are read; what is between two near ones is read with them, as more stretches would cost more
        cut = np.flatnonzero(np.diff(live) > GAP)
        first, last = live[np.append(0, cut + 1)[: len(live)]], live[np.append(cut, -1)[: len(live)]] + 1
        self.met += self.blocks
        self.skipped += self.blocks - int((last - first).sum())
        if len(at) and len(live):
            lo, hi = self.begin[place[:, None], first].ravel().astype(np.int64), self.begin[place[:, None], last].ravel().astype(np.int64)
            near += np.bincount(*self._read(np.repeat(at, len(first)), lo, hi, np.repeat(w, len(first)), read), self.width)
            least = self._top(near, k)[1]
        # in a block that was skipped no example reaches the threshold
        a = np.flatnonzero(near >= max(least, 1e-9))
        s = near[a]
        return a[s >= np.partition(s, -k)[-k] - self.slack] if len(s) > k else a

    def _top(self, near: np.ndarray, k: int) -> tuple[np.ndarray, float]:
        """The largest value in each block, and a bound that the k best reach: as many cells as that have an example that does."""
        cells = near.reshape(CELL, -1).max(axis=0)
        least = max(0.0, float(np.partition(cells, -k)[-k]) - self.slack) if len(cells) > k else 0.0
        return near.reshape(-1, BLOCK).max(axis=1), least

    def _exact(self, terms: np.ndarray, weights: np.ndarray, a: np.ndarray, k: int, read: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of ``a`` by sums in double precision, and the parts of these sums."""
        counted = np.zeros((len(a), len(terms)))  # 1 + log of how often each example holds each term of the query
        dense = np.flatnonzero(self.dense_place[terms] >= 0)
        segment, row = np.divmod(a, SEGMENT)
        found = self.values.take(self.row_begin[segment[:, None], self.dense_place[terms[dense]]] + row[:, None])
        counted[:, dense] = self.log.take(np.rint(np.exp(found - 1)).astype(np.int32))  # back to the count, then in double precision
        self.mark[a], self.asked[a] = True, np.arange(len(a))
        for own, stop, at, rows in read:
            hit = np.flatnonzero(self.mark.take(rows))
            counted[self.asked.take(rows[hit]), own[np.searchsorted(stop, hit, "right")]] = self.log.take(self.counts.take(at[hit]))
        self.mark[a] = False
        counted *= weights * self.idf[terms]
        counted /= self.length[a][:, None]
        s = np.round(counted.sum(axis=1), 9)
        best = np.lexsort((a, -s))[:k]
        best = best[s[best] > 0]
        return a[best], s[best], counted[best]
