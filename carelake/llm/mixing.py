"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are counted into cells of source, language and topic.  Raking multiplies the token mass of each cell by
a factor of its source, one of its language and one of its topic, fitting the three marginals in turn.
Given the language and topic factors, the source factors follow in closed form, so a sweep is one aggregate
over the cells that returns the mass by language and topic; sources, however many, stay distributed.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, written
from .quality_rules import SPACE, SYMBOLS

SWEEPS, TOLERANCE, WANTED = 100, 1e-10, 1e-6  # sweeps at most; gap at which they end, and above which a warning says so
ALPHA = {"source": 0.7, "lang": 0.9, "topic": 0.9}  # a target share is the own share to this power, normed
BUDGET = 0.8  # share of all tokens that the sample should hold
SEED = "mix-1"


def tokens_of(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic of a text from its form: symbols, length."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(F.coalesce(symbols, F.lit(0)) * 10 >= F.greatest(tokens, F.lit(1)), "marked").when(tokens < 100, "brief").when(tokens < 1000, "prose").otherwise("long")


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by the id, or by the text of a row without one: the first 52 bits of a digest."""
    by_text = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    text = F.concat(F.coalesce(doc_id.cast("string"), by_text), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


@dataclass(frozen=True)
class Weights:
    """``cells``: source, lang, topic, tokens, weight (target share per token); ``scale``: probability is min(1, scale * weight)."""

    cells: DataFrame
    scale: float
    sweeps: int
    gap: float


def _lookup(factors: dict[str, float], key: Column) -> Column:
    """The factor of each key, as one literal parsed once."""
    return F.element_at(F.from_json(F.lit(json.dumps(factors)), T.MapType(T.StringType(), T.DoubleType())), key)


def rake(cells: DataFrame, alpha: dict[str, float] = ALPHA, budget: float = BUDGET, sweeps: int = SWEEPS) -> Weights:
    """Fit the weights of ``cells`` (source, lang, topic, tokens); cells of no tokens get weight 0."""
    own = cells.filter("tokens > 0")
    total = own.agg(F.sum("tokens")).first()[0]
    if not total:
        return Weights(cells.withColumn("weight", F.lit(0.0)), 0.0, 0, 0.0)
    by_source = own.groupBy("source").agg(F.pow(F.sum("tokens") / F.lit(float(total)), F.lit(alpha["source"])).alias("target"))
    norm = by_source.agg(F.sum("target")).first()[0]
    own = written(own.join(by_source.withColumn("target", F.col("target") / norm), "source"), "cells")

    def target(c: str) -> dict[str, float]:
        share = {r[0]: (r[1] / total) ** alpha[c] for r in own.groupBy(c).agg(F.sum("tokens")).collect()}
        return {k: v / sum(share.values()) for k, v in share.items()}

    want_l, want_t = target("lang"), target("topic")  # languages and topics are short lists; sources need not be
    f_l, f_t = dict.fromkeys(want_l, 1.0), dict.fromkeys(want_t, 1.0)

    def fitted() -> DataFrame:
        """The cells with the source factors that fit the language and topic factors."""
        x = own.withColumn("f", _lookup(f_l, F.col("lang")) * _lookup(f_t, F.col("topic")))
        z = x.groupBy("source").agg(F.sum(F.col("tokens") * F.col("f")).alias("z"))
        return x.join(z, "source").withColumn("weight", F.col("target") * F.col("f") / F.col("z"))

    gap, done = 0.0, 0
    for done in range(1, sweeps + 1):
        mass = {(r[0], r[1]): r[2] for r in fitted().groupBy("lang", "topic").agg(F.sum(F.col("tokens") * F.col("weight"))).collect()}
        got_l = {k: sum(v for (x, _), v in mass.items() if x == k) for k in want_l}
        up = {k: want_l[k] / got_l[k] for k in want_l}
        got_t = {k: sum(v * up[x] for (x, y), v in mass.items() if y == k) for k in want_t}
        raw_t = {k: sum(v for (_, y), v in mass.items() if y == k) for k in want_t}
        gap = max(*(abs(u - 1) for u in up.values()), *(abs(want_t[k] / raw_t[k] - 1) for k in want_t))
        f_l = {k: f * up[k] for k, f in f_l.items()}
        f_t = {k: f * want_t[k] / got_t[k] for k, f in f_t.items()}
        if gap < TOLERANCE:
            break
    if gap > WANTED:
        # a language or topic that is confined to some sources cannot always have its share
        warnings.warn(f"raking ended after {done} sweeps with a marginal {gap:.2g} off its target", stacklevel=2)
    out = written(fitted().select("source", "lang", "topic", "tokens", "weight"), "weights")
    # The scale that gives the budget: cells whose probability would pass 1 are certain, the others share the rest.
    scale, before = 0.0, -1
    while True:
        sure = F.col("weight") * F.lit(scale) >= 1
        n, held, rest = out.agg(
            F.count_if(sure), F.coalesce(F.sum(F.when(sure, F.col("tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~sure, F.col("tokens") * F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == before or not rest:
            break
        scale, before = (budget * total - held) / rest, n
    return Weights(out, scale, done, gap)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    alpha: dict[str, float] = ALPHA,
    budget: float = BUDGET,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``topic, tokens, weight, probability, sampled`` of every row.

    Targets: each marginal's own token shares to the power ``alpha``, normed.  ``weight`` is the target share
    per token of the row's cell, ``probability`` is min(1, scale x weight) with the scale that makes the
    expected tokens ``budget`` of all, and a row is sampled if the number in [0, 1) that its id fixes lies
    below it: the same rows on every run, and repeated rows alike; rows without an id are drawn by their texts.  If the
    targets cannot be met together, or not in ``SWEEPS`` sweeps, a warning gives the largest relative gap that is left.  Null sources, languages and topics are
    the cell of the empty string; a text without words has weight 0, probability 1 and is always kept, as it
    weighs nothing.  An empty table gives none.  Columns of the input that have one of the new names stay, and the
    new one gets underscores before its name.
    """
    names = {c: fresh(docs, c) for c in ("topic", "tokens", "weight", "probability", "sampled", "_source", "_lang")}
    full = docs.withColumn(names["tokens"], tokens_of(F.col(text_col)))
    topic = topic if topic is not None else topic_of(F.col(text_col), F.col(names["tokens"]))
    empty = F.lit("")
    full = full.withColumns({
        names["topic"]: F.coalesce(topic, empty),
        names["_source"]: F.coalesce(F.col(source_col).cast("string"), empty),
        names["_lang"]: F.coalesce(F.col(lang_col).cast("string"), empty),
    })
    cells = full.groupBy(
        F.col(names["_source"]).alias("source"), F.col(names["_lang"]).alias("lang"), F.col(names["topic"]).alias("topic")
    ).agg(F.sum(names["tokens"]).alias("tokens"))
    found = rake(written(cells, "cells"), alpha, budget)
    key = [F.col(f"w.{k}").eqNullSafe(F.col(f"d.{names[n]}")) for k, n in (("source", "_source"), ("lang", "_lang"), ("topic", "topic"))]
    joined = full.alias("d").join(found.cells.alias("w"), key[0] & key[1] & key[2], "left")
    weight = F.coalesce(F.col("w.weight"), F.lit(0.0))
    weight = F.when(F.col(f"d.{names['tokens']}") > 0, weight).otherwise(0.0)
    p = F.when(weight == 0, 1.0).otherwise(F.least(F.lit(1.0), weight * F.lit(found.scale)))
    out = joined.select(
        *[F.col(f"d.`{c}`") for c in [*docs.columns, names["topic"], names["tokens"]]], weight.alias(names["weight"]), p.alias(names["probability"])
    )
    return out.withColumn(names["sampled"], uniform(F.col(id_col), F.col(text_col), seed) < F.col(names["probability"]))
