"""Learned decision lists over text statistics, in DataFrame operations only.

Sequential covering: a rule is a conjunction of thresholds grown for the gain it brings on two thirds of
the labelled rows, pruned on the last third, and kept if it is precise there; the rows it covers are set
aside and the next one is grown.  All counts are aggregates over the labelled rows; the driver sees counts by
feature and bin only.  The list is emitted as one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEATED = 3  # words of the windows whose repeats are counted
FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share"]
MAX_LABELLED = 500_000  # labelled rows that the list is fitted on, by hash of the id
BINS, MAX_RULES, MAX_CONDITIONS = 24, 8, 3
MIN_PRECISION, MIN_COVER = 0.9, 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once.  A column that a lambda refers to may be inlined there by the optimizer
    and computed for each element; a lambda's own variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_repeat_words(words: Column) -> Column:
    """Words inside windows of ``REPEATED`` words that the array holds twice or more."""

    def windows(w: Column) -> Column:
        whole = F.slice(w, F.lit(1), F.greatest(F.size(w) - (REPEATED - 1), F.lit(0)))
        return F.transform(whole, lambda x, i: F.struct(F.concat_ws(" ", x, *[F.get(w, i + j) for j in range(1, REPEATED)]).alias("g"), i.alias("i")))

    def repeated(s: Column) -> Column:  # equal windows stand side by side once the windows are sorted
        return F.array_compact(F.transform(s, lambda x, i: F.when((F.get(s, i - 1)["g"] == x["g"]) | (F.get(s, i + 1)["g"] == x["g"]), x["i"])))

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(REPEATED)), F.lit(REPEATED)))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x, lambda a: a.cast("long"))

    at = _let(words, lambda w: _let(F.sort_array(windows(w)), repeated))
    return _let(F.sort_array(at), covered)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct`` of every whole text.

    Words are runs of other characters than the six ASCII white-space ones.  ``n_dup_lines`` counts lines
    with a word that equal an earlier line, ``n_repeat_words`` the words inside three-word windows that the
    text has twice or more.  A null text has none of anything; each row gives a row.
    """
    own = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    own = own.withColumn("w", words_of(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = own.select(
        id_col, "w", lines.alias("lines"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    return own.select(
        id_col, "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("w")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """The numbers that rules put thresholds on; 0 where a text has no words or lines."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = features()[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first whose conditions all hold rejects the text, and a text that none meets is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def kept(self) -> Column:
        out = F.when(F.lit(False), F.lit(False))
        for rule in self.rules:
            out = out.when(_all([c.column() for c in rule]), F.lit(False))
        return out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "".join("if " + " and ".join(map(str, r)) + " then reject\n" for r in self.rules) + "else keep"


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """Information gained about the covered positives."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p and p0 else 0.0


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DecisionList:
    """The decision list that rejects what ``label_col`` = 0 marks, from the rows of ``stats`` that pass the base rules.

    Several labels of one id count as the lowest; null labels are left out.  At most about ``MAX_LABELLED``
    rows, picked by the id's hash, are used.  No labels, or labels of one kind, give an empty list.
    """
    bad = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg((F.min(label_col) == 0).alias("bad"))
    rows = stats.filter(~base_failed()).join(bad, id_col)
    h = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1_000_000))
    names = list(FEATURES)
    own = written(rows.select("bad", h.alias("h"), *[c.alias(n) for n, c in features().items()]), "labelled")
    total = own.count()
    share = min(1.0, MAX_LABELLED / max(1, total))
    own = own.filter(F.col("h") < math.ceil(share * 1_000_000))
    cuts = [(i + 0.5) / BINS for i in range(BINS)]
    asked = own.groupBy("bad").agg(*[F.percentile_approx(n, cuts, 1000).alias(n) for n in names]).collect()
    if len(asked) < 2:
        return DecisionList(())
    # a threshold lies half way between two neighbouring quantiles, of either class
    limits: dict[str, list[float]] = {}
    for n in names:
        seen = sorted({float(x) for r in asked for x in r[n]})
        limits[n] = [(a + b) / 2 for a, b in zip(seen, seen[1:], strict=False)] or [seen[0]]
    binned = own.select(
        "bad", (F.pmod(F.col("h"), F.lit(3)) == 0).alias("prunes"),
        *[F.expr("+".join(f"int(`{n}` > {t!r}D)" for t in limits[n])).alias(n) for n in names],
    )
    binned = written(binned.groupBy("bad", "prunes", *names).agg(F.count(F.lit(1)).alias("k")), "binned")

    def holds(rule: list[tuple[str, bool, int]]) -> Column:
        return _all([F.col(f) > b if above else F.col(f) <= b for f, above, b in rule])

    def by_bin(rows: DataFrame) -> dict[str, dict[int, list[int]]]:
        long = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names]))
        counted = rows.select("bad", "k", long.alias("x")).groupBy("x.f", "x.b").agg(
            F.sum(F.when(F.col("bad"), F.col("k")).otherwise(0)).alias("p"), F.sum("k").alias("all")
        )
        out: dict[str, dict[int, list[int]]] = {n: {} for n in names}
        for r in counted.collect():
            out[r["f"]][r["b"]] = [r["p"], r["all"] - r["p"]]
        return out

    rules: list[tuple[Condition, ...]] = []
    left = binned
    while len(rules) < MAX_RULES:
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < MAX_CONDITIONS:
            counts = by_bin(left.filter(~F.col("prunes") & holds(rule)))
            p0, n0 = (sum(c[i] for c in counts[names[0]].values()) for i in (0, 1))
            best = (1e-9, None)
            for f in names:
                p = n = 0
                for b in range(len(limits[f])):
                    own_p, own_n = counts[f].get(b, (0, 0))
                    p, n = p + own_p, n + own_n
                    for above, cp, cn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if cp >= MIN_COVER and cp + cn < p0 + n0:
                            best = max(best, (_gain(p0, n0, cp, cn), (f, above, b)), key=lambda x: x[0])
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        held = left.filter("prunes").agg(*[
            F.sum(F.when(holds(rule[:i]) & (F.col("bad") == bad), F.col("k")).otherwise(0)).alias(f"c{i}_{int(bad)}")
            for i in range(1, len(rule) + 1) for bad in (True, False)
        ]).first()
        worth = [((held[f"c{i}_1"] or 0) - (held[f"c{i}_0"] or 0)) / max(1, (held[f"c{i}_1"] or 0) + (held[f"c{i}_0"] or 0)) for i in range(1, len(rule) + 1)]
        size = 1 + max(range(len(rule)), key=lambda i: (worth[i], -i))
        p, n = held[f"c{size}_1"] or 0, held[f"c{size}_0"] or 0
        if p < MIN_COVER or p / (p + n) < MIN_PRECISION:
            break
        rule = rule[:size]
        rules.append(tuple(Condition(f, above, limits[f][b]) for f, above, b in rule))
        left = left.filter(~holds(rule))
    return DecisionList(tuple(rules))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The statistics of every row with ``base_failed`` and ``kept``; ``kept`` is false if the base rules or the learned list reject it."""
    stats = written(statistics(docs, id_col, text_col), "statistics")
    found = learn(stats, labels, id_col, label_col)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & found.kept())
