"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import hard_negatives as hn


def plain(rows, is_anchor, positives=5, negatives=3):
    own = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))  # noqa: E731  missing components are 0
    out = []
    for n, (i, label, q) in enumerate(own):
        if not is_anchor(i):
            continue
        scored = sorted(((-dot(q, v), j, m, y) for m, (j, y, v) in enumerate(own)))
        near = [(j, -s) for s, j, m, y in scored if y == label and m != n][:positives]
        for j, p in near:
            found = [(k, -s) for s, k, _, y in scored if y != label and 50 * p <= -100 * s <= 95 * p][:negatives]
            out += [(i, j, r + 1, k, p, s) for r, (k, s) in enumerate(found)]
    return sorted(out)


def made(n, dims=8, seed=3, spread=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0.3, spread) * (1 + i % 4) for _ in range(dims)]
        rows.append((i, rng.randint(0, 3), v))
    rows += [(3, 1, None), (4, None, rows[4][2]), (None, 1, rows[5][2]), (6, 1, [None] * dims), (7, 1, [float("nan")] * dims), (8, 2, [float("inf")] + [0.0] * (dims - 1)), (9, 2, []), (10, 1, [0.0] * dims)]
    rows += rows[20:30]  # repeated rows, anchors among them
    rows += [(900 + i, i % 4, rows[11][2]) for i in range(40)]  # ties
    return rows


@pytest.mark.parametrize("bucket,anchors", [(4096, 16_384), (64, 10)])
def test_same_as_all_products(spark, monkeypatch, bucket, anchors):
    monkeypatch.setattr(hn, "BUCKET", bucket)
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    rows = made(500)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, uid string, score int").repartition(5)
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 300


def test_feasible_ranges_keep_every_match_and_prune():
    rng = np.random.default_rng(1)
    m = np.rint(rng.normal(0, 40, (3000, 16)) * rng.choice([1, 1.1], (3000, 1))).astype(np.int64)
    m[:, 3] += np.where(rng.random(3000) < 0.1, 900, 0)  # few vectors point along one axis
    orders = np.argsort(m.T, axis=1, kind="stable").astype("<u2")
    b = hn.Bucket(0, len(m), 16, np.arange(3000).astype("<i8").tobytes(), np.zeros(3000, "<i8").tobytes(), np.zeros(3000, "u1").tobytes(), m.astype("<i4").tobytes(), orders.tobytes())
    pruned = 0
    for i in range(0, 3000, 37):
        q = m[i]
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        full = m @ q
        for least in (int(full.max() * 0.5), int(full.max() * 0.9), int(full.max()), int(full.max()) + 1):
            rows = b.candidates(q, length, least, np.argsort(-np.abs(q), kind="stable")[: hn.FOCUS].tolist())
            if rows is not None:
                assert set(np.flatnonzero(full >= least)) <= set(rows.tolist())
                assert (b.products(q, rows) == full[rows]).all()
                pruned += len(rows) < 0.5 * len(m)
    assert pruned > 20


def test_large_components_stay_exact():
    m = np.array([[hn.LIMIT, -hn.LIMIT, 3], [hn.LIMIT - 1, hn.LIMIT, -7]], np.int64)
    orders = np.argsort(m.T, axis=1, kind="stable").astype("<u2")
    b = hn.Bucket(0, 2, 3, np.arange(2).astype("<i8").tobytes(), np.zeros(2, "<i8").tobytes(), np.zeros(2, "u1").tobytes(), m.astype("<i4").tobytes(), orders.tobytes())
    assert b.products(m[1], None).tolist() == [int(sum(int(x) * int(y) for x, y in zip(r, m[1], strict=True))) for r in m]


def test_no_rows_no_anchors(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hn.hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(1, 1, [1.0, 2.0]), (50, 1, None)], "vec_id long, label int, embedding array<float>")
    assert hn.hard_negatives(one, F.col("vec_id") % 50 == 0).count() == 0
