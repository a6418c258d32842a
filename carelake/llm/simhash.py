"""SimHash near-duplicates found with vantage-point trees.

64-bit fingerprints of word shingles that differ in few bits are linked, and linked documents form a
component.  In whole fingerprints a vantage point prunes little: distances between unrelated ones gather
near 32, all within a few bits of any radius.  But of the two 32-bit halves of a pair that differs in
``distance`` bits one differs in at most half of them, so the trees are built over the halves and searched
with that smaller distance, which prunes well; candidates are then compared in whole.  The top of each tree comes
from a bounded sample of fingerprints and deals all of them out to shards, each fingerprint to its home and
as a query to every shard its search ball overlaps.  The sample decides the shards' shapes alone: results
are exact with any tree.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, written

SHINGLE, DISTANCE, SEED = 3, 3, 42
SHARD = 20_000  # fingerprints that a shard should hold
SAMPLE_PER_SHARD = 16  # fingerprints of the sample that shapes the tree, for each shard
SAMPLE = 1 << 18  # fingerprints of the sample at most, however many shards there should be
BLOCK = 1 << 16  # shingles of a text hashed at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half the XXH64 values of the text's shingles (with repeats); 0 for no words."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: A-Z alone, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    digest, seen = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first[i : i + BLOCK], last[i : i + BLOCK], strict=True)], np.uint64)
        seen += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(seen * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` of every row; ``fp`` holds the 64 bits as a signed number."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(make, schema)


def near_links(distinct: DataFrame, count: int, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links among the distinct fingerprints ``fp`` that join what all pairs within ``distance`` would."""
    import numpy as np

    from . import vptree

    near = distance // 2
    shards = max(1, count // SHARD)
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(shards * SAMPLE_PER_SHARD + 1, SAMPLE))
    picked = np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64)
    trees = [vptree.build(_half(picked, h), SAMPLE_PER_SHARD) for h in (0, 1)]

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for h, tree in enumerate(trees):
                row, leaf, home = vptree.route(tree, _half(fp.view(np.uint64), h), near)
                yield pa.RecordBatch.from_arrays([pa.array(leaf * 2 + h, pa.int64()), pa.array(fp[row], pa.int64()), pa.array(home)], names=["shard", "fp", "home"])

    def deal_again(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            shard, fp, home = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2))
            for h, tree in enumerate(trees):  # shards of half h by the other one
                own = np.flatnonzero(shard % 2 == h)
                row, leaf, inner = vptree.route(trees[1 - h], _half(fp[own].view(np.uint64), 1 - h), distance)
                at = own[row]
                yield pa.RecordBatch.from_arrays([pa.array(shard[at]), pa.array(leaf, pa.int64()), pa.array(fp[at], pa.int64()), pa.array(home[at].astype(bool) & inner)], names=["shard", "sub", "fp", "home"])

    def search(key, own):
        import pyarrow as pa

        h, within = (key[0].as_py() % 2, near) if key[1].as_py() < 0 else (1 - key[0].as_py() % 2, distance)
        fp = own.column("fp").to_numpy().copy()
        full = fp.view(np.uint64)
        a, b = vptree.links(full, _half(full, h), own.column("home").to_numpy(), within, distance)
        return pa.table({"a": pa.array(fp[a], pa.int64()), "b": pa.array(fp[b], pa.int64())})

    dealt = written(distinct.select("fp").mapInArrow(deal, "shard long, fp long, home boolean"), "shards")
    # A half that very many fingerprints share cannot be split by a tree over that half.  But the other halves of linked
    # pairs there differ in ``distance`` bits at most, and fingerprints are distinct, so such a shard is dealt again by these.
    large = [r[0] for r in dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 4 * SHARD).select("shard").collect()]
    parts = dealt.select("shard", F.lit(-1).cast("long").alias("sub"), "fp", "home")
    if large:
        again = dealt.filter(F.col("shard").isin(large)).mapInArrow(deal_again, "shard long, sub long, fp long, home boolean")
        parts = parts.filter(~F.col("shard").isin(large)).unionByName(again)
    return parts.groupBy("shard", "sub").applyInArrow(search, "a long, b long")


def _half(fp, h: int):
    import numpy as np

    return ((fp >> np.uint64(32 * h)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node: the least node reachable, by large and small stars in turn.

    Each round rewires the links towards smaller nodes and is written out; a node with very many links is
    met by aggregates that combine before the shuffle and by joins that Spark may split.
    """
    e = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, fp, component_id``.

    ``fp`` is the SimHash of the text's word shingles as a signed 64-bit number; a null or blank text has
    fingerprint 0 and is linked like any other.  Documents whose fingerprints differ in at most ``distance``
    bits are linked; ``component_id`` is the smallest id reachable, the own one included (null only if every id
    of the component is null).  Copies share one fingerprint and are compared once; ties and repeated rows
    need no further rule.  An empty table gives no rows; other columns are not read.
    """
    each, of_fp = _components_of(docs, id_col, text_col, shingle, distance)
    return each.join(of_fp, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), "fp", "component_id")


def _components_of(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``id, fp`` of every row, and of each fingerprint ``_fp, root, component_id``: the root alone tells components
    apart, as ids may repeat or be null."""
    each = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(each.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    count = distinct.count()
    if not count:
        return each, distinct.select(F.col("fp").alias("_fp"), F.col("fp").alias("root"), F.col("first").alias("component_id"))
    linked = components(near_links(distinct, count, distance))
    rooted = distinct.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return each, rooted.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")


def fingerprint_hex(fp: str):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, null ids last.

    Of a component's rows that repeat this id, the one with the smallest text stays.  Components are told apart by
    their fingerprints, so rows of unrelated texts all stay, also if they share an id or have none.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    _, of_fp = _components_of(docs, id_col, text_col, shingle, distance)
    fp, text = fresh(docs, "fp_of_row"), fresh(docs, "text_to_hash")
    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])

    def make(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        arrow = to_arrow_schema(schema)
        for b in batches:
            found = np.array([fingerprint(x, shingle) for x in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            old = [b.column(i).cast(arrow.field(i).type) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*old, pa.array(found, pa.int64())], names=arrow.names)

    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(text)).mapInArrow(make, schema)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = rows.select(F.col(fp).alias("_fp"), F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"), row.alias("_row"))
    first = rows.join(of_fp, "_fp").filter(F.col("_id").eqNullSafe(F.col("component_id")))
    return first.groupBy("root").agg(F.min_by("_row", F.struct("_text")).alias("_row")).select("_row.*")
