"""Fingerprints that very many others share a half with."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import common, simhash


def joined(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    groups = defaultdict(set)
    for x in list(up):
        groups[root(x)].add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("side", [0, 1])
def test_a_shared_half_is_spread_and_loses_no_link(spark, monkeypatch, side):
    monkeypatch.setattr(simhash, "SHARD", 100)
    common.prepare(spark)
    rng = np.random.default_rng(side)
    half = rng.integers(0, 1 << 32, 3000, dtype=np.uint64)
    near = half[:400] ^ (np.uint64(1) << rng.integers(0, 32, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 32, 400).astype(np.uint64))
    hot = np.concatenate([half, near]) << np.uint64(32 * side) | np.uint64(0xABCDEF12) << np.uint64(32 * (1 - side))
    other = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    fp = np.unique(np.concatenate([hot, other, other[:100] ^ np.uint64(5)]))
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long").repartition(6)
    taken = []
    real = simhash.written
    monkeypatch.setattr(simhash, "written", lambda d, name: taken.append(real(d, name)) or taken[-1])
    got = simhash.near_links(df, len(fp))
    got = joined((r.a, r.b) for r in got.filter(F.col("a") != F.col("b")).collect())
    want = []
    for i in range(len(fp)):
        hit = np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= 3) + i + 1
        want += [(int(fp.view(np.int64)[i]), int(fp.view(np.int64)[j])) for j in hit]
    assert got == joined(want) and len(got) > 300
    assert taken[0].groupBy("shard").count().filter("count > 2500").count() >= 1  # there was a hot shard
