"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Texts are bags of terms: the first ``STEM`` bytes of their words, so that the forms of a word meet.  A bounded sample of labelled rows gives
the examples, and every term that any of them holds is indexed: none is left out by frequency or by label.  Weights are plain
TF-IDF, (1 + log tf) * log((2 + n) / (1 + df)), normed to length 1; see :mod:`.block_max` for the exact search.

The nearest examples vote.  A vote weighs by closeness, and only so much of it counts as comes from terms that tell the labels
apart: the similarity is a sum over shared terms, and each term's part counts by its relevance, which grows with how surely and
how strongly the term's frequency differs between the labels.  The share of votes is calibrated on the examples themselves, each
with itself left out.
"""

from __future__ import annotations

import weakref
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .block_max import BlockMaxIndex
from .common import fold, fresh, hold_alone, written

STEM = 6  # bytes of a word that make its term
MAX_EXAMPLES = 20_000  # labelled training rows, by hash of the id, that the classifier is fitted on
FLOOR, SURE_Z, MOST_LIFT = 0.02, 10.0, 3.0  # relevance of a term that tells nothing; where its growth with z and log lift ends
NEIGHBOURS, EVIDENCE = 64, 5
BATCH, STRETCH = 64, 1024  # texts searched for together, out of so many put in order
FREQUENT = 0.05  # share of the examples from which on a term may be the main one of a text
PRIOR_WEIGHT, BINS = 1e-3, 20
THRESHOLD, FOLDS, HELD_OUT = 0.3, 4, 2
COUNTED, WORDS_KEPT = 400_000, 100_000

# A-Z to a-z; what belongs to no word to a blank
_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    found: Counter = Counter()
    for word, n in Counter(text.translate(_WORDS).split()).items():
        found[word[:STEM]] += n
    return found


def main_term(term: np.ndarray, count: np.ndarray, frequent: np.ndarray) -> int:
    """The one of the frequent terms that a text holds most often; -1 without any.  Like texts have the same."""
    own = np.flatnonzero(frequent[term])
    return int(term[own[count[own].argmax()]]) if len(own) else -1


class Numbers(dict):
    """Number of each term, and of words met, as long as there are at most ``most``; -1 without one."""

    most = 0

    def __missing__(self, word: bytes) -> int:
        number = self.get(word[:STEM], -1)
        if len(self) < self.most:
            self[word] = number
        return number


class Vectors:
    """Texts as sorted term numbers with counts; ``terms`` are sorted byte strings, a term's number is its place."""

    def __init__(self, terms: np.ndarray) -> None:
        self.terms, self.number = terms, None

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "number": None}

    def counts(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text the sorted term numbers and how often it holds each."""
        if self.number is None:
            self.number = Numbers((x, i) for i, x in enumerate(self.terms.tolist()))
            self.number.most = len(self.number) + WORDS_KEPT
        number = self.number.__getitem__
        for text in texts:
            found = Counter(text.translate(_WORDS).split())
            t = np.fromiter(map(number, found), np.int32, len(found))
            n = np.fromiter(found.values(), np.int32, len(found))
            at = np.argsort(t)
            at = at[np.searchsorted(t, 0, sorter=at) :]
            t, n = t[at], n[at]
            first = np.flatnonzero(np.diff(t, prepend=-1))  # words of one term are added up
            yield t[first], np.add.reduceat(n, first) if len(first) else n


_HELD: weakref.WeakSet[Scorer] = weakref.WeakSet()  # whose index this process holds; a scorer goes with the broadcast that brought it


def _drop_indexes(but: Scorer | None = None) -> None:
    for other in [s for s in _HELD if s is not but]:
        other.index = other.vectors.number = None
        _HELD.discard(other)


class Scorer:
    """All that a task needs: terms with weights and relevance, the examples' term counts, and the calibration.

    It travels as the term numbers and counts of the examples; the index is made of them once in each worker.
    """

    def __init__(self, terms: np.ndarray, idf: np.ndarray, relevance: np.ndarray, ids: list, labels: list[int], starts: np.ndarray, term: np.ndarray, count: np.ndarray, prior: float) -> None:
        self.vectors, self.idf, self.relevance, self.ids, self.labels = Vectors(terms), idf, relevance, ids, np.array(labels, float)
        self.starts, self.term, self.count, self.prior, self.index, self.frequent, self.shared = starts, term, count, prior, None, None, None
        self.levels = np.linspace(0, 1, 2)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"index": None, "frequent": None, "shared": None}

    def ready(self) -> BlockMaxIndex:
        hold_alone("index of examples", _drop_indexes)
        if self.index is None:
            _drop_indexes(but=self)  # one index a process: workers outlive the queries that they serve
            _HELD.add(self)
            self.index, self.place = BlockMaxIndex(self.starts, self.term, self.count, self.idf), {x: i for i, x in enumerate(self.ids)}
            self.frequent = np.bincount(self.term, minlength=len(self.idf)) > FREQUENT * len(self.ids)
        return self.index

    def votes(self, texts: list[bytes], without: list | None = None) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """For each text the share of votes for label 1, and the weightiest voters with their similarities."""
        index = self.ready()
        for lo in range(0, len(texts), STRETCH):
            queries, main = [], []
            for t, n in self.vectors.counts(texts[lo : lo + STRETCH]):
                w = (1.0 + np.log(n)) * self.idf[t]
                queries.append((t, w / np.sqrt(w @ w) if len(t) else w))
                main.append(main_term(t, n, self.frequent))
            left_out = [-1] * len(queries) if without is None else [self.place.get(x, -1) for x in without[lo : lo + STRETCH]]
            found: list = [None] * len(queries)
            order = np.argsort(main, kind="stable").tolist()  # texts that share many terms are searched for together
            for own in (order[i : i + BATCH] for i in range(0, len(order), BATCH)):
                nearest = index.search([queries[q] for q in own], NEIGHBOURS, [left_out[q] for q in own])
                for q, (at, sims, parts) in zip(own, nearest, strict=True):
                    vote = (parts * self.relevance[queries[q][0]]).sum(axis=1)
                    share = float((vote @ self.labels[at] + PRIOR_WEIGHT * self.prior) / (vote.sum() + PRIOR_WEIGHT))
                    best = np.argsort(-vote, kind="stable")[:EVIDENCE]
                    found[q] = share, at[best], sims[best]
            yield from found

    def calibrated(self, share: float) -> float:
        return float(np.interp(share, np.linspace(0, 1, len(self.levels)), self.levels))


def monotone(positive: list[float], total: list[float]) -> np.ndarray:
    """Shares by bin that never fall: neighbouring bins that would are pooled."""
    pools: list[list[float]] = []
    for p, n in zip(positive, total, strict=True):
        pools.append([p, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, n2, c2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + n2, pools[-1][2] + c2]
    return np.concatenate([np.full(int(c), p / n) for p, n, c in pools])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """Fit on at most ``MAX_EXAMPLES`` labelled rows outside the held-out fold, taken by the hash of the id.

    Several labels of one id count as the highest; null labels and ids are left out; a repeated document
    is one example.  Without labels, or with labels of one kind, nothing tells texts apart: every text scores 0.
    """
    train = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col), FOLDS) != HELD_OUT))
    train = train.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    picked = train.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(MAX_EXAMPLES)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most MAX_EXAMPLES pairs of id and label are broadcast, so no text is shuffled but the examples'
    examples = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    examples = written(examples, "examples")
    n1, n = examples.agg(F.sum("y"), F.count(F.lit(1))).first()
    n1, n0 = n1 or 0, n - (n1 or 0)
    none = np.zeros(0)
    if not n1 or not n0:
        return Scorer(none.astype("S1"), none, none, [], [], np.zeros(1, np.int64), none.astype(np.int32), none.astype(np.uint16), 0.0)

    def frequencies(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: Counter = Counter()  # examples with the term, those of label 1 in the upper half

        def out():
            n = np.fromiter(seen.values(), np.int64, len(seen))
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(n >> 32), pa.array(n & 0xFFFFFFFF)], names=["term", "a", "b"])

        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                one = 1 << 32 if y else 1
                for x in term_counts(text):
                    seen[x] += one
                if len(seen) > COUNTED:
                    yield out()
                    seen.clear()
        yield out()

    counted = examples.select("y", "text").mapInArrow(frequencies, "term binary, a long, b long").groupBy("term")
    found = counted.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()  # terms of MAX_EXAMPLES texts at most
    terms = np.array(found.column("term").to_pylist(), f"S{STEM}")
    order = np.argsort(terms)
    terms, a, b = terms[order], *(found.column(c).to_numpy()[order].astype(float) for c in ("a", "b"))
    del found, order
    both = a + b
    p = both / n
    z = np.abs(a / n1 - b / n0) / np.sqrt(np.maximum(p * (1 - p), 0.25 / n) * (1 / n1 + 1 / n0))
    lift = np.abs(np.log((a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))))
    relevance = (FLOOR + np.minimum(z / SURE_Z, 1.0) * np.minimum(lift, MOST_LIFT)).astype(np.float32)
    idf = np.log((2.0 + n) / (1.0 + both))
    frequent = both > FREQUENT * n
    del a, b, p, z, lift
    spark = examples.sparkSession
    shared = spark.sparkContext.broadcast((terms, frequent))  # terms of MAX_EXAMPLES texts at most

    def numbered(batches: Iterator) -> Iterator:
        import pyarrow as pa

        terms, frequent = shared.value
        vectors = Vectors(terms)
        for b in batches:
            found = list(vectors.counts(b.column(2).cast(pa.binary()).to_pylist()))
            key = [main_term(t, n, frequent) for t, n in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(key, pa.int64()), pa.array([t.tobytes() for t, _ in found], pa.binary()), pa.array([np.minimum(n, 65535).astype(np.uint16).tobytes() for _, n in found], pa.binary())],
                names=["id", "y", "key", "term", "n"],
            )

    kind = examples.schema["id"].dataType.simpleString()
    rows = examples.select("id", "y", "text").mapInArrow(numbered, f"id {kind}, y int, key long, term binary, n binary")
    rows = rows.withColumn("size", F.length("term")).orderBy("key", F.desc("size"), "id").toArrow()  # MAX_EXAMPLES at most
    size = rows.column("size").to_numpy() // 4
    own = size > 0
    labels_of = rows.column("y").to_numpy()
    bare = labels_of[~own]
    ids = [x for x, k in zip(rows.column("id").to_pylist(), own.tolist(), strict=True) if k]
    term, count = array("i"), array("H")
    for chunk in rows.to_batches(max_chunksize=1024):  # examples without a term add nothing
        for c, into in (("term", term), ("n", count)):
            into.frombytes(b"".join(chunk.column(c).to_pylist()))
    del rows
    prior = (n1 + 0.5) / (n + 1)
    starts = np.concatenate([[0], np.cumsum(size[own])]).astype(np.int64)
    scorer = Scorer(terms, idf, relevance, ids, labels_of[own].tolist(), starts, np.frombuffer(term, np.int32), np.frombuffer(count, np.uint16), (bare.sum() + 0.5 * prior) / (len(bare) + 0.5))
    scorer.shared = held = spark.sparkContext.broadcast(scorer)

    def left_out(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            shares = [v[0] for v in held.value.votes(b.column(2).cast(pa.binary()).to_pylist(), b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([min(BINS - 1, int(s * BINS)) for s in shares], pa.int32()), b.column(1)], names=["bin", "y"])

    by_bin = {r[0]: (r[1], r[2]) for r in examples.select("id", "y", "text").mapInArrow(left_out, "bin int, y int").groupBy("bin").agg(F.sum("y"), F.count(F.lit(1))).collect()}
    return _with_levels(scorer, [by_bin.get(i, (0, 0))[0] for i in range(BINS)], [by_bin.get(i, (0, 0))[1] for i in range(BINS)])


def _with_levels(scorer: Scorer, positive: list[float], total: list[float]) -> Scorer:
    """Calibration: each bin's share of label 1, drawn to its own middle by two pseudo-rows, made monotone."""
    middle = (np.arange(len(total)) + 0.5) / len(total)
    scorer.levels = monotone([p + 2 * m for p, m in zip(positive, middle, strict=True)], [t + 2.0 for t in total])
    return scorer


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` (all) of every row with ``score, predicted, evidence``, and the names these columns got.

    ``score`` is the calibrated chance of label 1, ``predicted`` 1 if it is at least ``THRESHOLD``,
    ``evidence`` those ``EVIDENCE`` of the nearest examples whose votes weigh most, with similarity and label.  A null or empty text,
    like any without a term of the examples, has no evidence and scores by the prior of such examples.  Repeated rows score alike;
    an empty table gives none; a column of the input that has one of the three names stays, and the new one
    gets underscores before its name.
    """
    keep = list(docs.columns) if keep is None else keep
    names = {c: fresh(docs, c) for c in ("score", "predicted", "evidence")}
    kept = [f for f in docs.schema.fields if f.name in keep]
    schema = T.StructType([
        *kept, T.StructField(names["score"], T.DoubleType()), T.StructField(names["predicted"], T.IntegerType()),
        T.StructField(names["evidence"], T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("similarity", T.DoubleType()), T.StructField("label", T.IntegerType())]))),
    ])
    shared, levels = scorer.shared or docs.sparkSession.sparkContext.broadcast(scorer), scorer.levels  # MAX_EXAMPLES vectors at most
    text = fresh(docs, "text_to_score")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, s = to_arrow_schema(schema), shared.value
        s.levels = levels
        for b in batches:
            shares, found = [], []
            for share, at, sims in s.votes(b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()):
                shares.append(s.calibrated(share))
                found.append([{"id": str(s.ids[i]), "similarity": v, "label": int(s.labels[i])} for i, v in zip(at.tolist(), sims.tolist(), strict=True)])
            new = [pa.array(shares, pa.float64()), pa.array([int(v >= THRESHOLD) for v in shares], pa.int32()), pa.array(found, arrow.field(arrow.names[-1]).type)]
            old = [b.column(i).cast(arrow.field(i).type) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*old, *new], names=arrow.names)

    source = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.coalesce(F.col(text_col), F.lit("")).alias(text))
    return source.mapInArrow(run, schema), names


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    found, names = score(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
    return found.filter(F.col(names["predicted"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


