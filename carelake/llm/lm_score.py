"""Language-model score of whole texts by a subword lattice.

The model's vocabulary holds the pieces of an existing subword vocabulary and the words of the training texts, each
with a unigram score.  A text's probability sums over all segmentations of its words into these entries:
a word is either one whole entry or a path of pieces through the lattice (:mod:`.lattice`), whose forward
recursion in log space gives the sum.  Training counts words by class (a column such as the language),
discounts them as Kneser and Ney do, and gives what the discounts free to a model of words new to a class,
which counts not how often but in how many classes a word was seen:

    P(w | class) = (max(c(w, class) - D, 0) + (D V(class) + 1) P(w)) / (N(class) + 1)
    P(w)         = (max(m(w) - d, 0) + (d V + 1) lattice(w)) / (M + 2)

with m(w) the number of classes that hold w, M its sum, V the distinct words, and the end of a text as one more
token, never discounted and seen once in P.  The piece probabilities start from the scores of
the existing vocabulary and are re-estimated by expected counts over the distinct training words.  A
text's probability sums over the classes as well, so every step is a proper distribution.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, written
from .lattice import END, PieceLattice, load_pieces

FOLDS, HELD_OUT = 7, 2
CLASSES = 8  # the classes of most training texts; all others are the last one
ROUNDS = 2  # re-estimations of the piece probabilities
PRIOR_WEIGHT = 100.0  # words that the existing scores weigh as
COMMON_WORDS = 200_000  # most frequent words sent to every task; all others are looked up by a join
COUNTED = 300_000  # distinct words that a task counts before it passes them on
STOP = END


@dataclass
class Model:
    """Counts and discounts: overall, then by class."""

    classes: list[str]
    texts: list[int]  # training texts by class
    tokens: int  # N
    types: int  # V, with the end
    spread: int  # M
    discount: float
    class_tokens: list[int]
    class_types: list[int]
    class_discount: list[float]

    @property
    def ends(self) -> int:
        return sum(self.texts)

    def class_columns(self, by_class: list, lattice):
        """Log10 probability of a word in each class from its counts and its lattice log probability (columns)."""
        n, free = self.spread + 2, self.discount * max(0, self.types - 1) + 1
        whole = (F.greatest(_classes_with(by_class) - self.discount, F.lit(0.0)) + free * F.exp(lattice)) / float(n)
        out = []
        for k, c in enumerate(by_class):
            own_n, own_free = self.class_tokens[k] + 1, self.class_discount[k] * self.class_types[k] + 1
            p = (F.greatest(c - self.class_discount[k], F.lit(0.0)) + own_free * whole) / float(own_n)
            # a word too unlikely for a double was never counted: its lattice share alone, in logs
            tail = math.log10(free / n * own_free / own_n) + lattice / math.log(10.0)
            out.append(F.when(p > 1e-290, F.log10(p)).otherwise(tail))
        return out

    def end_log10(self) -> list[float]:
        whole = 1 / (self.spread + 2)
        return [
            math.log10((t + (d * v + 1) * whole) / (n + 1))
            for t, n, v, d in zip(self.texts, self.class_tokens, self.class_types, self.class_discount, strict=True)
        ]


def _classes_with(by_class: list):
    """In how many classes a word was counted."""
    seen = [(c > 0).cast("double") for c in by_class]
    return sum(seen[1:], seen[0])


def _split(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z alone, and the six ASCII white-space characters


def count_words(docs: DataFrame, classes: list[str]) -> DataFrame:
    """``word, c0..cK``: training count of each word of any text by class; ``docs`` is id, text, class, held_out."""
    last = len(classes) - 1

    def counts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number = {c: i for i, c in enumerate(classes[:-1])}
        seen: list[Counter] = [Counter() for _ in range(last + 2)]

        def out():
            for k, c in enumerate(seen):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array([k] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())], names=["word", "k", "n"])
                    c.clear()

        for b in batches:
            for text, cls, held in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seen[last + 1 if held else number.get(cls, last)].update(_split(text))
                if sum(map(len, seen)) > COUNTED:
                    yield from out()
        yield from out()

    each = docs.select("text", "class", "held_out").mapInArrow(counts, "word binary, k int, n long")
    return each.groupBy("word").agg(*[F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(last + 1)])


def train(words: DataFrame, classes: list[str], texts: list[int]) -> Model:
    """Totals and discounts in one aggregate over the distinct words."""
    cs = [F.col(f"c{k}") for k in range(len(classes))]
    total = sum(cs[1:], cs[0])
    m = _classes_with(cs)
    cols = [F.sum(total), F.count_if(total > 0), F.count_if(m == 1), F.count_if(m == 2)]
    for c in cs:
        cols += [F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]
    *r, spread = [x or 0 for x in words.agg(*cols, F.sum(m)).first()]

    def discount(n1: int, n2: int) -> float:
        return n1 / (n1 + 2 * n2) if n1 else 0.5

    per = [r[4 * i : 4 * i + 4] for i in range(len(cs) + 1)]
    ends = sum(texts)
    return Model(
        classes, texts, per[0][0] + ends, per[0][1] + (1 if ends else 0), int(spread), discount(*per[0][2:]),
        [p[0] + t for p, t in zip(per[1:], texts, strict=True)], [p[1] for p in per[1:]], [discount(*p[2:]) for p in per[1:]],
    )


def _gathered(batches: Iterator, rows: int = 50_000, size: int = 8 << 20) -> Iterator:
    """Record batches put together to about ``rows`` rows, so that work on arrays pays."""
    import pyarrow as pa

    held: list = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows or sum(x.nbytes for x in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _normed(pieces: list[bytes], mass: np.ndarray) -> np.ndarray:
    """Log probabilities: word-start pieces sum to 1, and so do the others with the stop symbol."""
    start = np.array([p[:1] == b" " for p in pieces])
    out = np.empty(len(mass))
    for side in (start, ~start):
        out[side] = np.log(mass[side] / mass[side].sum())
    return out


def fit_pieces(words: DataFrame, model_file: str, n_classes: int, rounds: int = ROUNDS) -> PieceLattice:
    """The existing pieces with probabilities re-estimated over the distinct training words (each counts once)."""
    pieces, log_prior = load_pieces(model_file)
    prior = np.exp(log_prior)
    lattice = PieceLattice(pieces, _normed(pieces, prior))
    stop, start = pieces.index(STOP), np.array([p[:1] == b" " for p in pieces])
    spark = words.sparkSession
    known = words.filter("+".join(f"c{k}" for k in range(n_classes)) + " > 0").select("word")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(lattice)  # tens of thousands of pieces, whatever the corpus

        def expected(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa

            own, total, n = shared.value, np.zeros(len(shared.value.pieces)), 0
            for b in _gathered(batches):
                found = b.column(0).to_pylist()
                total += own.run(found, np.ones(len(found)))[1]
                n += len(found)
            total[own.pieces.index(STOP)] += n
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], names=["piece", "n"])

        counts = np.zeros(len(pieces))
        for piece, n in known.mapInArrow(expected, "piece int, n double").groupBy("piece").agg(F.sum("n")).collect():
            counts[piece] = n
        shared.unpersist()
        if not counts[stop]:
            break
        mass = np.where(start, prior / prior[start].sum(), prior / prior[~start].sum()) * PRIOR_WEIGHT + counts
        lattice = PieceLattice(pieces, _normed(pieces, mass))
    return lattice


def _with_lattice(words: DataFrame, lattice: PieceLattice) -> DataFrame:
    """``words`` with ``lattice``: the natural log of the sum over all paths of pieces, with the stop symbol."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)
    schema = T.StructType([*words.schema.fields, T.StructField("lattice", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = shared.value
        for b in _gathered(batches):
            found, _ = own.run(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found + own.end_log_p)], names=[*b.schema.names, "lattice"])

    return words.mapInArrow(run, schema)


def lm_scores(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", class_col: str = "lang", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are words (runs of other characters than the six ASCII white-space ones, A-Z lower-cased) and one
    end.  The model learns from rows whose crc32 of the id, modulo ``FOLDS``, is not ``HELD_OUT``; a null id is
    never held out.  ``score`` is the log10 probability of the whole text, summed over segmentations and
    classes; ``base_score`` sums log10((c+1)/(N+V+1)) over the tokens, with c, N and V of the training tokens.  A
    null or blank text is its end alone.  Null classes are one class; repeated rows score alike; without
    training rows words come from the lattice with the existing scores, and every other token is an end.  An empty table gives none.
    """
    spark = docs.sparkSession
    own = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(class_col).cast("string"), F.lit("")).alias("class"),
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
    )
    sizes = own.filter(~F.col("held_out")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), "class").limit(CLASSES - 1).collect()
    n_train = sizes.agg(F.sum("n")).first()[0] or 0
    classes = [r["class"] for r in top] + [None]
    texts = [r["n"] for r in top] + [n_train - sum(r["n"] for r in top)]
    words = written(count_words(own, classes), "words")
    model = train(words, classes, texts)
    lattice = fit_pieces(words, model_file, len(classes), rounds)
    cs = [F.col(f"c{k}").cast("double") for k in range(len(classes))]
    total = sum(cs[1:], cs[0])
    scored = _with_lattice(words, lattice).select("word", total.alias("c"), *[x.alias(f"s{k}") for k, x in enumerate(model.class_columns(cs, F.col("lattice")))])
    scored = written(scored, "scored-words")
    names = [f"s{k}" for k in range(len(classes))]
    # at most COMMON_WORDS rows: what is left over is joined, so no word's rows are many
    common = scored.orderBy(F.desc("c"), "word").limit(COMMON_WORDS).toArrow()
    table = spark.sparkContext.broadcast((common.column("word").combine_chunks(), np.column_stack([common.column(n).to_numpy() for n in ["c", *names]])))
    below = model.tokens + model.types
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()),
        *[T.StructField(n, T.DoubleType()) for n in names],
        T.StructField("rare", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))),
    ])

    def first_pass(batches: Iterator) -> Iterator:
        """Sums over the common words of each text, and its other words with their counts."""
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        found, values = _common(table.value)
        arrow, row = to_arrow_schema(schema), TaskContext.get().partitionId() << 40
        for b in batches:
            sums, tokens, known, rare_at, rare_words, rare_n = [], [], [], [0], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                c = Counter(_split(text))
                at, n = [], []
                for w, k in c.items():
                    i = found.get(w)
                    if i is None:
                        rare_words.append(w)
                        rare_n.append(k)
                    else:
                        at.append(i)
                        n.append(k)
                rare_at.append(len(rare_words))
                tokens.append(c.total() + 1)
                k = np.array(n, float)
                v = values[at]
                known.append(int(k @ (v[:, 0] > 0)) + (1 if model.ends else 0))
                sums.append(np.concatenate([[k @ np.log10((v[:, 0] + 1) / (below + 1))], k @ v[:, 1:]]))
            s = np.array(sums).reshape(b.num_rows, len(names) + 1)
            kind = arrow.field("rare").type
            rare = pa.ListArray.from_arrays(pa.array(rare_at, pa.int32()), pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_n, pa.int64())], fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + b.num_rows)), b.column(0), b.column(2), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), *[pa.array(s[:, i]) for i in range(s.shape[1])], rare.cast(kind)],
                names=arrow.names,
            )
            row += b.num_rows

    # written once, so that the row numbers stay as they are
    rows = written(own.select("id", "text", "held_out").mapInArrow(first_pass, schema), "first-pass")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("n"))
    looked = rare.join(scored, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / float(below + 1))).alias("_base"),
        *[F.sum(F.col("n") * F.col(n)).alias(f"_{n}") for n in names],
    )
    full = rows.drop("rare").join(looked, "row", "left")
    ends = model.end_log10()
    share = [t / n_train if n_train else 1.0 / len(classes) for t in texts]
    by_class = [F.col(n) + F.coalesce(f"_{n}", F.lit(0.0)) + (e + math.log10(p)) for n, e, p in zip(names, ends, share, strict=True) if p > 0]
    full = full.withColumn("by_class", F.array(*by_class)).withColumn("most", F.array_max("by_class"))
    score = F.col("most") + F.log10(F.aggregate("by_class", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.col("most"))))
    base_end = math.log10((model.ends + 1) / (below + 1))
    return full.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("_base", F.lit(0.0)) + base_end).alias("base_score"), score.alias("score"),
    )


_HELD: dict[int, tuple] = {}


def _common(shared: tuple) -> tuple[dict[bytes, int], np.ndarray]:
    """The common words as a dictionary, made once per worker process and broadcast."""
    key = id(shared)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = (shared, {w: i for i, w in enumerate(shared[0].to_pylist())})
    return _HELD[key][1], shared[1]


