"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window of a benchmark item is a set of shingles at fixed places, and a text contains the window only if
it has every one of them.  So the necessary prefix of the set, in the order of rarity in the corpus, is its
single rarest shingle: texts' shingles are joined with these by equality, bounds on length and position
drop candidates whose window would not fit in the text, and what is left is verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, lower_ascii

WINDOW = 10  # words
SHINGLE = 2  # words of a joined shingle; a window of fewer words is one shingle
#: Windows that are broadcast at once (about 200 bytes each); a larger benchmark is joined block by block.
BLOCK_WINDOWS = 500_000
# Everything but digits, letters a-z and characters beyond ASCII separates words (after lower-casing).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def n_words_of(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS_ANY_CASE), "")).cast("long")


def windows_of(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct ``(item, words)`` windows of the items; an item of fewer words is one, an item of none has none."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("w"))
    long = F.greatest(F.size("w") - window, F.lit(0))
    at = items.filter(F.size("w") > 0).select("item", "w", F.explode(F.sequence(F.lit(0), long)).alias("i"))
    return at.select("item", F.slice("w", F.col("i") + 1, F.lit(window)).alias("words")).distinct()


def _shingle(words: str, pos: Column, k: int) -> Column:
    """The shingle of ``k`` words from ``pos`` (0-based) on."""
    return F.concat_ws(" ", *[F.get(F.col(words), pos + j if j else pos) for j in range(k)])


def _shingles(df: DataFrame, words: str, k: int) -> DataFrame:
    """A row for each place of each array of at least ``k`` words: ``pos`` and ``shingle``."""
    each = df.select("*", F.posexplode(words).alias("pos", "word"))
    if k == 1:
        return each.withColumnRenamed("word", "shingle")
    return each.filter(F.col("pos") <= F.size(words) - k).withColumn("shingle", _shingle(words, F.col("pos"), k)).drop("word")


def _occurrences(docs: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """``id, h, item, at, n`` of every occurrence of a window of at least ``k`` words."""
    keyed = _shingles(windows.select("item", "words"), "words", k)
    listed = keyed.select("shingle").distinct()
    # rarity: how often each shingle of the benchmark stands in the whole corpus
    rarity = (
        _shingles(docs.select("w"), "w", k).select("shingle")
        .join(F.broadcast(listed), "shingle", "left_semi")
        .groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    )
    prefix = (
        keyed.join(rarity, "shingle")  # a shingle that no text has rules its window out ...
        .groupBy("item", "words")
        .agg(F.min(F.struct("seen", "shingle", "pos")).alias("rarest"), F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == F.size("words") - k + 1)  # ... so all shingles of a window must be there
        .select("item", F.col("words").alias("window"), F.col("rarest.shingle").alias("shingle"), F.col("rarest.pos").alias("off"))
    )
    # windows of one text are verified once and then stand for all items that share them
    shared = prefix.groupBy("window", "shingle", "off").agg(F.collect_set("item").alias("items"))
    at = F.col("pos") - F.col("off")
    hits = _shingles(docs.select("id", "h", "w"), "w", k).join(F.broadcast(shared), "shingle").filter(
        (at >= 0) & (at + F.size("window") <= F.size("w")) & (F.slice("w", at + 1, F.size("window")) == F.col("window"))
    )
    return hits.select("id", "h", at.alias("at"), F.size("window").alias("n"), "items")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit, n_items, items, contaminated``.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII.  A document word is
    hit if it lies inside an occurrence of ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  ``items`` are the ids (as text, sorted as text) of the items with an
    occurring window; items without an id share the id of the empty string.  Null texts have no words and are clean, as are all documents against an empty
    benchmark; null ids are an id like any other; rows that repeat an id are judged by their own text, and
    exact repeats alike; of the columns only those named are read.  An empty table gives no rows.
    """
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
    cut = own.select("id", "h", words_of(F.col("t")).alias("w"))
    windows = windows_of(benchmark, item_col, item_text_col, window)
    sizes = {r["short"]: r["n"] for r in windows.groupBy((F.size("words") < SHINGLE).alias("short")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = None
    for short, n in sorted(sizes.items()):
        some = windows.filter((F.size("words") < SHINGLE) == F.lit(short))
        blocks = -(-n // BLOCK_WINDOWS)
        for b in range(blocks):  # a window is in one block, so no occurrence is met twice
            part = some if blocks == 1 else some.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)
            more = _occurrences(cut, part, 1 if short else SHINGLE)
            found = more if found is None else found.unionByName(more)
    counted = own.select("id", "h", n_words_of(F.col("t")).alias("n_words"))
    none = F.array().cast("array<string>")
    if found is None:
        judged = counted.withColumns({"n_hit": F.lit(0).cast("long"), "items": none})
    else:
        # a text has no more occurrences than places, times the items that share one
        spans = found.groupBy("id", "h").agg(
            F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("to")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        covered = F.aggregate(
            "spans",
            F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto")),
            lambda a, s: F.struct(
                (a["hit"] + F.greatest(s["to"] - F.greatest(s["at"], a["upto"]), F.lit(0))).alias("hit"),
                F.greatest(a["upto"], s["to"]).alias("upto"),
            ),
            lambda a: a["hit"].cast("long"),
        )
        spans = spans.select(F.col("id").alias("_id"), F.col("h").alias("_h"), covered.alias("n_hit"), "items")
        judged = counted.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left").select(
            "id", "h", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
        )
    return judged.select(
        F.col("id").alias(id_col), F.col("h").alias("text_hash"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns."""
    bad = contamination(docs, benchmark, id_col, text_col).filter("contaminated")
    bad_id, bad_hash = fresh(docs, "bad_id"), fresh(docs, "bad_hash")
    bad = bad.select(F.col(id_col).alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad[bad_id]) & (F.xxhash64(docs[text_col]) == bad[bad_hash]), "left_anti")
