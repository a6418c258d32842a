"""Training-data pipeline over ``documents``: filter, de-duplicate, decontaminate, mix and write token ids.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a DataFrame;
all but the last return the columns of its documents.  :func:`run` writes each stage's result as Parquet in
the shared folder and reads it again for the next one.

Rows: ids may be null or repeated, texts null, empty or long, tables empty, columns more than the five of
``documents``; each operator's docstring says what then holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import decontaminate, mixing, simhash, token_output, toxicity
from carelake.llm.common import prepare, table, written
from carelake.llm.queries import vocabulary
from carelake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not mark as toxic."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of SimHash near-duplicates (3-word shingles, 3 bits)."""
    prepare(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by the calibrated probabilities of the target mix."""
    found = mixing.mix(docs)
    new = [c for c in found.columns if c not in docs.columns]
    sampled = new[-1]
    return found.filter(F.col(f"`{sampled}`")).select(*[F.col(f"`{c}`") for c in docs.columns])


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in Simple-8b sections and read back: place, length and checksum of each document."""
    prepare(spark)
    path = scratch_path(spark, "token-ids")
    token_output.write_token_ids(docs, path, vocabulary("byte_bpe_50k.json"))
    return token_output.read_token_ids(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL can express neither the neighbours' votes nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
