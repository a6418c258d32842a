"""Token-ID output: whole texts as ids, in ascending id order, in a table of Simple-8b sections.

Files: a Parquet table of sections, written by Spark's own writer so that it reaches any store.  A section
holds the ids of some consecutive whole documents, each closed by the end id, as Simple-8b bytes
(:mod:`.simple8b`), and the ids and lengths of these documents.  ``part`` and ``start_in_part`` place it:
parts are ranges of the document id in ascending order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECTION_IDS = 1 << 17  # a section is closed at the document that reaches so many ids


def _sections_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("start_in_part", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(id_type)),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ])


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the sections to ``path``.

    A null text counts as empty: its document holds the end id alone.  Null ids come first; rows of equal
    id follow each other in the order of their texts.  An empty table writes an empty table.  Columns other
    than the two named are not read.
    """
    id_type = docs.schema[id_col].dataType
    schema = _sections_schema(id_type)

    def sections(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        from .encoding import encode_ids
        from .simple8b import pack

        part, start = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        arrow = to_arrow_schema(schema)
        owners, lengths, held = [], [], []

        def section():
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [start], [len(ids)], [list(owners)], [list(lengths)], [pack(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for b in batches:
            for owner, ids in zip(b.column(0).to_pylist(), encode_ids(b.column(1).cast(pa.binary()).to_pylist(), tokenizer_path), strict=True):
                owners.append(owner)
                held.append(ids + end)
                lengths.append(len(ids) // 4 + 1)
                if sum(lengths[-1:]) >= SECTION_IDS or len(lengths) % 16 == 0 and sum(lengths) >= SECTION_IDS:
                    yield section()
                    start += sum(lengths)
                    owners, lengths, held = [], [], []
        if owners:
            yield section()

    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    own.mapInArrow(sections, schema).write.parquet(path)


def read_token_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it, ``n_tokens`` its own with the end id and
    ``ids_crc32`` is the unsigned crc32 of these as little-endian unsigned 32-bit integers.
    """
    sections = spark.read.parquet(path)
    id_type = sections.schema["doc_ids"].dataType.elementType
    # One row for each part that was written, so small enough to be added up in one task and broadcast.
    parts = sections.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("part_start"))
    placed = sections.join(F.broadcast(offsets), "part").select((F.col("part_start") + F.col("start_in_part")).alias("start"), "doc_ids", "lengths", "payload")
    schema = T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def documents(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .simple8b import unpack

        for b in batches:
            start, doc_ids, lengths, payload = b.columns
            for i in range(b.num_rows):
                size = np.array(lengths[i].as_py(), dtype=np.int64)
                stop = np.cumsum(size)
                data = unpack(payload[i].as_py()).astype("<u4")
                if len(data) != stop[-1]:
                    raise ValueError("section and document lengths differ")
                sums = [zlib.crc32(data[e - n : e]) for n, e in zip(size.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_ids[i].values, pa.array(start[i].as_py() + stop - size), pa.array(size), pa.array(sums, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(documents, schema)
