"""Token counts: batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row.

    ``n_tokens`` is what the ``tokenizers`` library gives for the whole text with the file at
    ``tokenizer_path`` (word-level kinds that drop white space), without added special tokens, padding
    or truncation; special strings inside a text count as the library takes them.  Long texts are cut at
    white space, where no token can reach across; distinct pieces are encoded in batches of about equal
    bytes and only their lengths leave the encoder.  A null text counts as empty (0 bytes, 0 tokens); an
    empty table gives none; repeated rows and null ids each give their own row; other columns of the
    input, whatever their names, are not read.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def counts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .encoding import encode_lengths

        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(encode_lengths(texts, tokenizer_path), pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    own = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return own.mapInArrow(counts, schema).withColumn("over_limit", F.col("n_tokens") > limit)
