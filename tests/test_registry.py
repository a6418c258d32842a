"""Key registry: dense, stable, without collisions."""

import random

import pytest

from carelake.operators.registry import KeyRegistry


def numbers(registry):
    return {tuple(r[:-1]): r[-1] for r in registry.numbers().collect()}


def test_numbers_are_dense_stable_and_ranked(spark, tmp_path):
    rng = random.Random(3)
    reg = KeyRegistry(spark, str(tmp_path / "r"), ["w", "p"])
    assert reg.numbers() is None
    first = [(rng.choice([None, 1, 2]), f"p{rng.randint(0, 400)}") for _ in range(1500)]
    df = spark.createDataFrame(first, "w int, p string")
    key = lambda k: tuple((x is not None, x if x is not None else 0) for x in k)
    old = sorted(set(first), key=key)
    assert reg.register(df.repartition(7)) == len(old)
    assert numbers(reg) == {k: i + 1 for i, k in enumerate(old)}
    assert reg.register(df.repartition(3)) == 0  # a repeated run changes nothing
    second = [(rng.choice([None, 1, 2, 3]), f"p{rng.randint(300, 700)}") for _ in range(1500)]
    new = sorted(set(second) - set(old), key=key)
    assert reg.register(spark.createDataFrame(second, "w int, p string")) == len(new)
    want = {k: i + 1 for i, k in enumerate(old + new)}
    assert numbers(reg) == want
    got = reg.attach(df, "k").collect()
    assert len(got) == len(first) and all(want[r.w, r.p] == r.k for r in got)


def test_a_failed_run_leaves_no_numbers(spark, tmp_path, monkeypatch):
    reg = KeyRegistry(spark, str(tmp_path / "r"), ["p"])
    reg.register(spark.createDataFrame([("a",), ("c",)], "p string"))
    with monkeypatch.context() as m:
        m.setattr(reg.versions, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            reg.register(spark.createDataFrame([("b",)], "p string"))
    assert numbers(reg) == {("a",): 1, ("c",): 2}
    reg.register(spark.createDataFrame([("b",), ("d",)], "p string"))
    assert numbers(reg) == {("a",): 1, ("c",): 2, ("b",): 3, ("d",): 4}
    assert reg.attach(spark.createDataFrame([("z",), (None,)], "p string"), "k").filter("k is not null").count() == 0
    assert reg.register(spark.createDataFrame([], "p string")) == 0
