"""Language identification by cross-parsing entropy.

For each learned language a bounded reference of labelled text becomes a suffix automaton.  A text is parsed
greedily into the longest phrases that occur in the reference; the phrase count c, normed to c * log2(N) / n for a
reference of N and a text of n symbols, estimates how many bits a symbol of the text takes a reader of that
language (Ziv and Merhav).  The language that needs the fewest wins.

Symbols are lower-case letters; a run of anything else is one blank.  Long texts are parsed in stretches, each
started anew, so that no text holds up the others of its batch; every symbol of every text is parsed.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, fresh
from .suffix_automaton import Parsers

FOLDS, HELD_OUT = 4, 2
REFERENCE = 40_000  # symbols of reference text for each language
ALL_REFERENCES = 1_000_000  # symbols of all references together: with many languages each gets its share
ROWS = 64  # labelled rows of each language, by hash of the id, that a reference is put together from
LETTERS = 62  # letters told apart, the most frequent of the references; the others share one symbol
STRETCH = 512  # symbols that are parsed in one go
SHARPNESS = 40.0  # how fast the score rises with the lead in bits a symbol
BATCH_CHARS = 1 << 21
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Learned languages in ascending order, the letters told apart, and each language's reference in symbols."""

    languages: tuple[str, ...]
    letters: str
    references: tuple[bytes, ...]


@functools.lru_cache(maxsize=4)
def _codes(letters: str):
    """Symbol of each code point below 2^16: 0 blank, 1 a letter not told apart, then the letters; the last entry is for all above."""
    import numpy as np

    t = np.zeros((1 << 16) + 1, np.uint8)
    t[[i for i in range(1 << 16) if chr(i).isalpha()]] = 1
    t[1 << 16] = 1
    for k, c in enumerate(letters):
        t[ord(c)] = 2 + k
    return t


def symbols_of(texts: list[str], letters: str):
    """``(symbols, starts, sizes)`` of the texts: lower case, each run of other characters one blank, none at the ends.

    A text without letters has size 0.  A code point of 2^16 or more counts as a letter if it is one.
    """
    import numpy as np

    joined = "\n".join(x.lower() for x in texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    high = code >= 1 << 16
    sym = _codes(letters)[np.minimum(code, 1 << 16)]
    if high.any():
        sym[high] = [1 if chr(c).isalpha() else 0 for c in code[high].tolist()]
    ends = np.cumsum([len(x.lower()) + 1 for x in texts])
    text = np.zeros(len(sym), np.int64)
    text[ends[:-1]] = 1
    text = np.cumsum(text)
    letter = sym > 0
    # a blank stays if it follows a letter of the same text and another letter of it comes later
    last = np.zeros(len(texts), np.int64)
    where = np.flatnonzero(letter)
    last[text[where]] = where
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (text[1:] == text[:-1])
    keep &= letter | (np.arange(len(sym)) < last[text])
    sizes = np.bincount(text[keep], minlength=len(texts))
    return sym[keep], np.cumsum(sizes) - sizes, sizes


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", reference: int = REFERENCE, rows: int = ROWS) -> Model:
    """References from labelled rows outside the held-out fold.

    Of each language the ``rows`` rows of least id hash are met in that order, those longer than a reference last, and their
    whole texts taken as long as they fit; only if none does, what fits of the first.  Rows with a null
    id, text or language teach nothing; a repeated text is taken once.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.filter(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT))
    long = F.length("text") > reference
    order = [long, F.xxhash64(F.col("id").cast("string")), F.xxhash64("text")]
    ranked = own.select("lang", F.substring("text", 1, reference).alias("text"), F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("n"))
    found: dict[str, list[str]] = {}
    for r in ranked.filter(F.col("n") <= rows).orderBy("lang", "n").collect():  # rows x reference symbols of each language at most
        found.setdefault(r["lang"], []).append(r["text"])
    return build(found, min(reference, ALL_REFERENCES // max(1, len(found))))


def build(texts: dict[str, list[str]], reference: int = REFERENCE) -> Model:
    """References of at most ``reference`` symbols from the distinct texts of each language, in their order."""
    languages = sorted(texts)
    counted: Counter = Counter()
    for x in languages:
        counted.update(c for text in set(texts[x]) for c in text.lower() if c.isalpha() and ord(c) < 1 << 16)
    letters = "".join(sorted(c for c, _ in sorted(counted.items(), key=lambda e: (-e[1], e[0]))[:LETTERS]))
    references = []
    for x in languages:
        taken, room = [], reference
        for text in dict.fromkeys(texts[x]):
            symbols = symbols_of([text], letters)[0].tobytes()
            if symbols and (len(symbols) < room or not taken):
                taken.append(symbols[:room])
                room -= len(taken[-1]) + 1
        references.append(b"\0".join(taken))
    kept = [k for k, r in enumerate(references) if r]
    return Model(tuple(languages[k] for k in kept), letters, tuple(references[k] for k in kept))


@functools.lru_cache(maxsize=2)
def _parsers(model: Model) -> Parsers:
    return Parsers(list(model.references), LETTERS + 2)


def entropies(texts: list[str], model: Model):
    """Bits a symbol (texts x languages) of each text for a reader of each language; 0 for texts without a letter."""
    import numpy as np

    symbols, starts, sizes = symbols_of(texts, model.letters)
    cuts = np.maximum(1, -(-sizes // STRETCH))
    row = np.repeat(np.arange(len(texts)), cuts)
    k = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = k * STRETCH
    counts = _parsers(model).phrases(symbols, starts[row] + begin, np.minimum(sizes[row] - begin, STRETCH))
    total = np.zeros((len(texts), len(model.languages)))
    np.add.at(total, row, counts)
    bits = np.log2(np.array([len(r) + 1.0 for r in model.references]))
    return total * bits / np.maximum(sizes, 1)[:, None], sizes


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text: ``und`` with score 0 where it has no letter or nothing was learned."""
    import numpy as np

    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return languages, scores
    group, size = [], 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            size += len(text)
        if group and (size >= BATCH_CHARS or i == len(texts) - 1):
            bits, sizes = entropies([texts[j] for j in group], model)
            best = bits.argmin(axis=1)
            share = np.exp2(-SHARPNESS * (bits - bits.min(axis=1, keepdims=True)))
            share = 1.0 / share.sum(axis=1)
            for j, b, s, n in zip(group, best.tolist(), share.tolist(), sizes.tolist(), strict=True):
                if n:
                    languages[j], scores[j] = model.languages[b], s
            group, size = [], 0
    return languages, scores


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of every row with ``lang_pred`` and ``score``.

    ``lang_pred`` is the learned language that parses the whole text into the fewest normed phrases (ties: the first in
    order of name), or ``und`` with score 0 if the text is null or has no letter, or if no language was learned.
    ``score`` is the language's share of 2^(-``SHARPNESS`` x bits a symbol) among all: 1 for a clear lead, 1/k in a tie of
    k.  Repeated rows give the same; an empty table gives none; a column of the input with one of the new names stays
    and the new one gets underscores before its name.
    """
    keep = list(docs.columns) if keep is None else keep
    kept = [f for f in docs.schema.fields if f.name in keep]
    schema = T.StructType([*kept, T.StructField(fresh(docs, "lang_pred"), T.StringType()), T.StructField(fresh(docs, "score"), T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ALL_REFERENCES symbols at most

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in batches:
            found, scores = predict(b.column(b.num_columns - 1).to_pylist(), shared.value)
            old = [b.column(i).cast(arrow.field(i).type) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*old, pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=arrow.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias(fresh(docs, "text_to_read"))).mapInArrow(run, schema)
