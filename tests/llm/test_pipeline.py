"""The pipeline, stage by stage, and the entry point with and without the training-data operators."""

import importlib
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelake.llm import common, decontaminate, mixing, simhash, toxicity
from carelake.llm.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = common.table(spark, D, "documents").withColumn("predicted", F.lit("own")).cache()
    labels, bench = common.table(spark, D, "labels"), common.table(spark, D, "benchmark")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_output"]
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, common.written(stage(spark, kept, D), name)
        if name != "token_output":
            assert kept.columns == docs.columns and kept.schema["doc_id"] == docs.schema["doc_id"]
        if name == "toxicity":
            found, names = toxicity.score(before, toxicity.fit(before, labels))
            want = ids(found.filter(F.col(names["predicted"]) == 0))
        elif name == "simhash_near_dedup":
            want = sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
        elif name == "benchmark_decontamination":
            want = ids(decontaminate.contamination(before, bench).filter("not contaminated"))
        elif name == "mixing":
            want = ids(mixing.mix(before).filter("sampled"))
        else:
            want = ids(before)
        assert ids(kept) == want and 0 < len(want) <= before.count(), name
    whole = corpus_pipeline.run(spark, D)
    assert whole.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(whole.collect(), key=lambda r: r.doc_id)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, 0), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word " * 30_000, None, None, 1), (3, "one", "fr", "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    for given in (docs, docs.limit(0)):
        kept = given
        for name, stage in corpus_pipeline.STAGES:
            kept = common.written(stage(spark, kept, D), name)
        assert kept.count() <= given.count() and (kept.count() > 0) == (given.count() > 0)


def test_every_operator_has_its_query():
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in QUERIES) == 1
    assert set(ORACLES) <= set(QUERIES)
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("gone", [["carelake.llm", "carelake.llm.queries"], ["corpus_pipeline"]])
def test_entry_works_without_them(monkeypatch, gone):
    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in gone else real(name, *a))
    for name in gone:
        monkeypatch.setitem(sys.modules, name, None)
    names = set(entry.queries())
    assert "agg_04_daily_admissions_by_ward" in names and "pipeline" not in names and set(entry.oracle_sql()) <= names
