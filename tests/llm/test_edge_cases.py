"""Null ids, clashing columns, rules given twice and targets that cannot be met."""

import random

import pytest
from pyspark.sql import functions as F

from carelake.llm import common, decontaminate, mixing, url_filter


def test_rows_without_an_id_are_sampled_one_by_one(spark):
    rows = [(None if i % 3 == 0 else i, f"word{i} " * (5 + i % 7), f"s{i % 5}", "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(df).filter("doc_id is null").agg(F.sum(F.col("sampled").cast("int")), F.sum("probability"), F.count(F.lit(1))).first()
    assert got[2] == 1000 and 0 < got[0] < 1000 and abs(got[0] - got[1]) < 5 * 1000**0.5
    twice = mixing.mix(df.unionAll(df)).filter("doc_id is null").groupBy("text").agg(F.countDistinct("sampled").alias("n"))
    assert twice.filter("n > 1").count() == 0  # repeated rows alike


def test_targets_that_cannot_be_met_are_reported(spark):
    cells = spark.createDataFrame([("a", "x", "t", 900), ("b", "y", "t", 100)], "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="off its target"):
        found = mixing.rake(cells, {"source": 0.7, "lang": 0.1, "topic": 1.0})
    assert found.gap > mixing.WANTED and found.sweeps == mixing.SWEEPS


def test_raking_that_converges_is_silent(spark, recwarn):
    cells = spark.createDataFrame([(s, x, t, 10 + 7 * i) for i, (s, x, t) in enumerate((s, x, t) for s in "abc" for x in "xy" for t in "tu")], "source string, lang string, topic string, tokens long")
    assert mixing.rake(cells).gap < 1e-6
    assert not [w for w in recwarn if "raking" in str(w.message)]


RULES = [
    ("org", "/", "allow"), ("example.org", "/a", "block"), ("example.org", "/a", "allow"), ("b.example.org", "/", "block"), ("example.org", "/a/x", "block"),
    ("é.org", "/", "block"), ("org", "/longer-path", "block"), ("x.com", "", "block"), ("com", "/", "allow"),
]


def test_both_ways_through_a_url_list_agree(spark, monkeypatch):
    common.prepare(spark)
    rng = random.Random(6)
    hosts = ["example.org", "b.example.org", "c.b.example.org", "é.org", "z.é.org", "x.com", "y.x.com", "com", "EXAMPLE.org", "net"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/a/x', '/a/xy', '/longer-path/é', '/b'])}{rng.choice(['', '?q', '#f'])}" for _ in range(300)] + [None, "nothing", "", "://"]
    df = spark.createDataFrame([(i, u, "own", 1, 2) for i, u in enumerate(urls)], "page_id long, url string, rule string, _v int, _h int")
    one = url_filter.filter_urls(df, RULES)
    monkeypatch.setattr(url_filter, "MAX_ENTRIES", 3)
    two = url_filter.filter_urls(df, RULES)
    assert one.columns == two.columns and "_v" in two.columns and "_rule" in two.columns
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    # the last of two equal rules counts
    hit = [r for r in two.collect() if r["_rule"] == "example.org/a"]
    assert hit and all(r.verdict == "allow" for r in hit)


def test_clean_documents_stay_whatever_their_columns(spark):
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(None, " ".join(words[:15])), ("b", " ".join(words[20:35]))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words[:12]), 5, "h"), (None, "clean words only", 6, "h"), (2, None, 7, "h")], "doc_id long, text string, _bad_id int, bad_hash string")
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["_bad_id"] for r in kept.collect()) == [6, 7]
    found = {r.doc_id: (r.n_hit, r.n_items, r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert found[1] == (12, 1, [""]) and found[2] == (0, 0, [])
