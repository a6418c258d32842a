"""Subword lattice: pieces of an existing vocabulary over byte strings.

A word is the byte string ``b" " + word``; the leading space is the word-start marker.  Every piece of
the vocabulary that matches a stretch of it is an edge of the word's lattice, and each path from end to
end is one segmentation.  :class:`PieceLattice` sums the probability of *all* paths with the forward
recursion in log space and, for training, the expected number of times each piece is used
(forward-backward).  All work is vectorised over the words of equal length of a batch.
"""

from __future__ import annotations

import math

import numpy as np

MARK = "▁"
END = b"\x00</s>"  # the end symbol: never matches text, it only takes its share of probability
LONG = 256  # words longer than this many bytes are walked one by one, in memory linear in their length
NONE = -np.inf


def load_pieces(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces (as bytes) and log prior of an existing sentencepiece vocabulary.

    Word-start pieces get a leading space byte; pieces with the marker elsewhere can match no word and
    are left out; byte pieces are single bytes, so that every text has a segmentation.  The stored score
    of a merge vocabulary is minus the piece's rank; by Zipf's law a piece of rank r weighs 1/(r + 2).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    best: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            piece, rank = bytes([int(text[3:5], 16)]), float(sp.get_piece_size())
        else:
            start = text.startswith(MARK)
            if MARK in text[start:]:
                continue
            piece, rank = (b" " if start else b"") + text[start:].encode(), -sp.get_score(i)
        if b" " in piece[1:]:
            continue
        best[piece] = min(rank, best.get(piece, math.inf))
    best[END] = 0.0
    pieces = sorted(best)
    weight = np.array([1.0 / (best[p] + 2.0) for p in pieces])
    return pieces, np.log(weight / weight.sum())


class PieceLattice:
    """Trie over the pieces plus their natural-log probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray) -> None:
        self.pieces, self.log_p = pieces, np.asarray(log_p, dtype=np.float64)
        node: dict[bytes, int] = {b"": 0}
        for p in pieces:
            for j in range(1, len(p) + 1):
                node.setdefault(p[:j], len(node))
        edges = sorted((node[k[:-1]] * 256 + k[-1], n) for k, n in node.items() if k)
        self._keys = np.array([k for k, _ in edges], dtype=np.int64)
        self._to = np.array([n for _, n in edges], dtype=np.int32)
        self._table: np.ndarray | None = None
        self._piece = np.full(len(node), -1, dtype=np.int64)
        for i, p in enumerate(pieces):
            self._piece[node[p]] = i
        self.end_log_p = float(self.log_p[pieces.index(END)])

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    @property
    def next(self) -> np.ndarray:
        """The next node by node and byte, 0 for none: 1 KB a node, made where it is used and never sent."""
        if self._table is None:
            self._table = np.zeros(len(self._piece) * 256, dtype=np.int32)
            self._table[self._keys] = self._to
        return self._table

    def _edges(self, w: np.ndarray) -> list[list[tuple[np.ndarray, int, np.ndarray]]]:
        """Lattice edges of the equally long words in the rows of ``w``: for each start, (rows, length, pieces)."""
        n, size = w.shape
        follow = self.next
        out: list[list[tuple[np.ndarray, int, np.ndarray]]] = []
        for start in range(size):
            rows, state, found = np.arange(n), np.zeros(n, dtype=np.int64), []
            for length in range(1, size - start + 1):
                state = follow[state * 256 + w[rows, start + length - 1]].astype(np.int64)
                ok = state > 0
                rows, state = rows[ok], state[ok]
                if not len(rows):
                    break
                piece = self._piece[state]
                hit = piece >= 0
                if hit.any():
                    found.append((rows[hit], length, piece[hit]))
            out.append(found)
        return out

    def _forward(self, edges: list, n: int) -> np.ndarray:
        alpha = np.full((len(edges) + 1, n), NONE)
        alpha[0] = 0.0
        for start, found in enumerate(edges):
            for rows, length, piece in found:
                to = alpha[start + length]
                to[rows] = np.logaddexp(to[rows], alpha[start, rows] + self.log_p[piece])
        return alpha

    def _backward(self, edges: list, n: int) -> np.ndarray:
        beta = np.full((len(edges) + 1, n), NONE)
        beta[-1] = 0.0
        for start in range(len(edges) - 1, -1, -1):
            own = beta[start]
            for rows, length, piece in edges[start]:
                own[rows] = np.logaddexp(own[rows], beta[start + length, rows] + self.log_p[piece])
        return beta

    def _long_edges(self, word: np.ndarray) -> list[list[tuple[int, int]]]:
        """(end, piece) of each start of one long word."""
        n = len(word)
        out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        starts, state, length = np.arange(n), np.zeros(n, dtype=np.int64), 0
        while len(starts):
            state = self.next[state * 256 + word[starts + length]].astype(np.int64)
            ok = state > 0
            starts, state, length = starts[ok], state[ok], length + 1
            piece = self._piece[state]
            for s, p in zip(starts[piece >= 0].tolist(), piece[piece >= 0].tolist(), strict=True):
                out[s].append((s + length, p))
            inside = starts + length < n
            starts, state = starts[inside], state[inside]
        return out

    def _long(self, word: bytes, weight: float, counts: np.ndarray | None) -> float:
        edges = self._long_edges(np.frombuffer(word, dtype=np.uint8).astype(np.int64))
        alpha = [NONE] * (len(word) + 1)
        alpha[0] = 0.0
        lp = self.log_p

        def add(a: float, b: float) -> float:
            hi, lo = (a, b) if a >= b else (b, a)
            return hi if lo == NONE else hi + math.log1p(math.exp(lo - hi))

        for s, found in enumerate(edges):
            if alpha[s] != NONE:
                for e, p in found:
                    alpha[e] = add(alpha[e], alpha[s] + lp[p])
        if counts is not None and alpha[-1] != NONE:
            beta = [NONE] * (len(word) + 1)
            beta[-1] = 0.0
            for s in range(len(word) - 1, -1, -1):
                for e, p in edges[s]:
                    if beta[e] != NONE:
                        beta[s] = add(beta[s], beta[e] + lp[p])
                        if alpha[s] != NONE:
                            counts[p] += weight * math.exp(alpha[s] + lp[p] + beta[e] - alpha[-1])
        return float(alpha[-1])

    def run(self, words: list[bytes], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural-log marginal of each word and, if ``weights`` are given, the expected piece counts."""
        score = np.zeros(len(words))
        counts = np.zeros(len(self.pieces)) if weights is not None else None
        size = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cut) if len(words) else []:
            length = int(size[group[0]])
            if length > LONG:
                for i in group:
                    score[i] = self._long(b" " + words[i], 0.0 if weights is None else float(weights[i]), counts)
                continue
            for part in np.array_split(group, max(1, len(group) * length // 400_000)):
                w = np.frombuffer(b"".join(b" " + words[i] for i in part), dtype=np.uint8).reshape(len(part), length).astype(np.int64)
                edges = self._edges(w)
                alpha = self._forward(edges, len(part))
                score[part] = alpha[-1]
                if counts is not None:
                    beta = self._backward(edges, len(part))
                    own = weights[part]
                    for start, found in enumerate(edges):
                        for rows, ln, piece in found:
                            use = np.exp(alpha[start, rows] + self.log_p[piece] + beta[start + ln, rows] - alpha[-1, rows])
                            counts += np.bincount(piece, weights=use * own[rows], minlength=len(counts))
        return score, counts


def reestimate(counts: np.ndarray, log_prior: np.ndarray, prior_weight: float) -> np.ndarray:
    """Log probabilities of expected counts smoothed by ``prior_weight`` pseudo-counts of the prior."""
    mass = counts + prior_weight * np.exp(log_prior)
    return np.log(mass / mass.sum())
