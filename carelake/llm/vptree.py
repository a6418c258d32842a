"""Vantage-point trees over 32-bit halves of fingerprints.

A node keeps a vantage point and a radius: values within the radius go left, the others right.  By the
triangle bound, a value whose distance from the vantage point differs from the radius by no more than the
search distance can have neighbours on both sides, so as a query it visits both; any other visits one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 256


@dataclass
class Tree:
    """Arrays over the nodes: vantage point, radius, left and right child; a leaf has radius -1 and its number as left."""

    vantage: np.ndarray
    radius: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int


def _split(values: np.ndarray) -> tuple[np.uint32, int, np.ndarray] | None:
    """Vantage point, radius and who goes left; None if one value is all there is."""
    for pick in (0, len(values) // 2, len(values) - 1):
        d = np.bitwise_count(values ^ values[pick]).astype(np.int64)
        if d.max() == 0:
            return None
        # the radius that splits most evenly
        below = np.cumsum(np.bincount(d))[:-1]
        radius = int(np.argmin(np.abs(below - len(values) / 2)))
        inner = d <= radius
        if not inner.all():
            return values[pick], radius, inner
    return None


def build(sample: np.ndarray, leaf: int) -> Tree:
    """A tree over a sample of values (unsigned 32-bit) with about ``leaf`` of them in each leaf."""
    vantage, radius, left, right, leaves = [], [], [], [], 0
    todo = [(np.sort(np.asarray(sample, np.uint32)), -1, False)]
    while todo:
        values, parent, is_left = todo.pop()
        node = len(vantage)
        if parent >= 0:
            (left if is_left else right)[parent] = node
        cut = _split(values) if len(values) > leaf else None
        vantage.append(0 if cut is None else int(cut[0]))
        radius.append(-1 if cut is None else cut[1])
        left.append(leaves if cut is None else -1)
        right.append(-1)
        if cut is None:
            leaves += 1
        else:
            todo += [(values[~cut[2]], node, False), (values[cut[2]], node, True)]
    return Tree(np.array(vantage, np.uint32), np.array(radius), np.array(left), np.array(right), leaves)


def route(tree: Tree, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, leaf, home)`` of every leaf that each value visits as a query within ``distance``; one is its home."""
    rows, at, home = [], [], []
    todo = [(0, np.arange(len(values)), np.ones(len(values), bool))]
    while todo:
        node, own, is_home = todo.pop()
        if not len(own):
            continue
        r = tree.radius[node]
        if r < 0:
            rows.append(own)
            at.append(np.full(len(own), tree.left[node]))
            home.append(is_home)
            continue
        d = np.bitwise_count(values[own] ^ tree.vantage[node]).astype(np.int64)
        goes = d - distance <= r
        todo.append((int(tree.left[node]), own[goes], (is_home & (d <= r))[goes]))
        goes = d + distance > r
        todo.append((int(tree.right[node]), own[goes], (is_home & (d > r))[goes]))
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(at), np.concatenate(home)


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of a[i] and b[i]: the least label of each joined class."""
    label = label.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:  # follow to the root
            up = new[new]
            if (up == new).all():
                break
            new = up
        new = new[label]
        if (new == label).all():
            return label
        label = new


def _leaf_links(full: np.ndarray, points: np.ndarray, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between queries and points that join exactly what all pairs within ``distance`` would join.

    Round by round each query takes its first near point of another class; a dense leaf so gives at most
    one link per query and round, never all its pairs.
    """
    nodes, code = np.unique(np.concatenate([queries, points]), return_inverse=True)
    q, p = code[: len(queries)], code[len(queries) :]
    label = np.arange(len(nodes))
    found_a, found_b = [], []
    step = max(1, (1 << 21) // max(1, len(p)))
    live = np.arange(len(q))  # queries that had a near point of another class
    while len(live):
        a, b, more = [], [], []
        for i in range(0, len(live), step):
            part = live[i : i + step]
            near = np.bitwise_count(full[nodes[q[part]]][:, None] ^ full[nodes[p]][None, :]) <= distance
            near &= label[q[part]][:, None] != label[p][None, :]
            first = near.argmax(axis=1)
            hit = near[np.arange(len(part)), first]
            a.append(q[part[hit]])
            b.append(p[first[hit]])
            more.append(part[hit])
        live = np.concatenate(more)
        if len(live):
            x, y = np.concatenate(a), np.concatenate(b)
            found_a.append(x)
            found_b.append(y)
            label = _roots(len(nodes), x, y, label)
    if not found_a:
        none = np.zeros(0, np.int64)
        return none, none
    return nodes[np.concatenate(found_a)], nodes[np.concatenate(found_b)]


def links(full: np.ndarray, half: np.ndarray, home: np.ndarray, near: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one shard that join what all its pairs within ``distance`` (and within ``near`` in the half) join.

    ``home`` marks the shard's own fingerprints; the others only query.  The shard's own tree is walked
    down to leaves of at most ``LEAF`` points, or of one value that no vantage point can split.
    """
    out_a, out_b = [], []
    todo = [(np.flatnonzero(home), np.arange(len(full)))]
    while todo:
        points, queries = todo.pop()
        if not len(points) or not len(queries):
            continue
        cut = _split(half[points]) if len(points) > LEAF else None
        if cut is None:
            a, b = _leaf_links(full, points, queries, distance)
            out_a.append(a)
            out_b.append(b)
            continue
        vantage, radius, inner = cut
        d = np.bitwise_count(half[queries] ^ vantage).astype(np.int64)
        todo.append((points[inner], queries[d - near <= radius]))
        todo.append((points[~inner], queries[d + near > radius]))
    if not out_a:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(out_a), np.concatenate(out_b)
