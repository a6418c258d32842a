"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the same bytes; where tokens of both end, the text falls into groups that align.  Shared ends
are found by halving: near the middle of an interval a common end is sought by bisection, each side's next end in
turn, and the two halves are searched on; an interval without one is a leaf and lies within one group.  All intervals
of one depth are halved at once, over all texts of a batch.  Texts are aligned in stretches of bounded size, cut where
both tokenizers are known to end a token.

Within the groups every overlapping pair of token occurrences is a link.  How many documents hold an id pair linked is
counted over the whole corpus, and each document is scored with these counts.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .encoding import ByteEncoder, PieceCache, balanced, id_bytes, pieces

STRETCH_BYTES = 1 << 18  # of a text aligned at once
BATCH_BYTES = 1 << 21
PAIRS_AT_ONCE = 1 << 21  # id pairs with their counts sent to tasks at once
HELD_PAIRS = 1 << 21  # id pairs that a task counts before it hands them on
BITS = 32  # a pair is one number: id of A above, id of B in the lower bits


def shared_cuts(a, b):
    """``(i, j)``: positions in the ascending ends ``a`` and ``b`` of all ends they share."""
    import numpy as np

    found_i, found_j = [], []
    one = np.zeros(1, np.int64)
    a0, a1, b0, b1 = one, one + len(a), one, one + len(b)
    while True:
        live = (a0 < a1) & (b0 < b1)
        a0, a1, b0, b1 = a0[live], a1[live], b0[live], b1[live]
        if not len(a0):
            break
        middle = (a0 + a1) // 2
        i, j = np.full(len(a0), -1), np.full(len(a0), -1)
        # to the right of the middle: each list's first end not before the other's
        todo, x = np.arange(len(a0)), middle.copy()
        while len(todo):
            y = np.searchsorted(b, a[x])
            inside = y < b1[todo]
            todo, x, y = todo[inside], x[inside], y[inside]
            same = b[y] == a[x]
            i[todo[same]], j[todo[same]] = x[same], y[same]
            todo, y = todo[~same], y[~same]
            x = np.searchsorted(a, b[y])
            inside = x < a1[todo]
            todo, x = todo[inside], x[inside]
        right = i >= 0
        # and where there is none, to its left
        todo = np.flatnonzero(~right)
        x = middle[todo] - 1
        while len(todo):
            inside = x >= a0[todo]
            todo, x = todo[inside], x[inside]
            y = np.searchsorted(b, a[x], "right") - 1
            inside = y >= b0[todo]
            todo, x, y = todo[inside], x[inside], y[inside]
            same = b[y] == a[x]
            i[todo[same]], j[todo[same]] = x[same], y[same]
            todo, y = todo[~same], y[~same]
            x = np.searchsorted(a, b[y], "right") - 1
        hit = i >= 0
        found_i.append(i[hit])
        found_j.append(j[hit])
        # between the middle and a cut to its right nothing is shared, nor beyond a cut to its left
        left = (a0[hit], np.minimum(middle, i)[hit], b0[hit], j[hit])
        after = (i[right] + 1, a1[right], j[right] + 1, b1[right])
        a0, a1, b0, b1 = (np.concatenate(p) for p in zip(left, after, strict=True))
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    order = np.argsort(i)
    return i[order], j[order]


class First:
    """Tokenizer A: byte-level, with the strings of special tokens as ordinary text."""

    whole = False

    def __init__(self, path: str) -> None:
        import numpy as np

        self.encoder = ByteEncoder(path, plain=True)
        of = {c: b for b, c in self.encoder.table.items()}
        vocabulary = self.encoder.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            self.bytes[k] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        self.cache = PieceCache(lambda batch: [_joining(x, v, self.bytes) for x, v in zip(batch, self.encoder(batch), strict=True)])

    def cut(self, text: bytes) -> list[bytes]:
        return [x for part in pieces(text, True) for x in part]


_BLANK = "▁"
_UNIT = re.compile(rb" +[^ ]*|[^ ]+")


class Second:
    """Tokenizer B: pieces that mark blanks at their start, on the text without the blank that it adds itself.

    No piece holds a blank after another character, so nothing is merged over such a place: each run of blanks is encoded
    with the word after it, apart from the rest.
    """

    def __init__(self, path: str) -> None:
        import numpy as np
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.whole = any(_BLANK in p.lstrip(_BLANK) for p in vocabulary)  # if a piece does, texts are encoded in one
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(_BLANK, " ").encode() for k, p in enumerate(vocabulary)]
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        self.blank = self.model.piece_to_id(_BLANK)
        self.cache = PieceCache(self._encode)

    def _encode(self, units: list[bytes]) -> list[bytes]:
        """Ids of units, each of which begins with the blank that the tokenizer adds."""
        found = self.model.encode([u[1:].decode("utf-8", "replace") for u in units], num_threads=1)
        # of an empty text it gives no pieces, not even the blank
        return [_joining(u, id_bytes(ids if len(u) > 1 else [self.blank]), self.bytes) for u, ids in zip(units, found, strict=True)]

    def cut(self, text: bytes) -> list[bytes]:
        return [text] if self.whole else _UNIT.findall(text)


def _joining(text: bytes, ids: bytes, spelled: list[bytes]) -> bytes:
    """The ids if their bytes join to the text, else none."""
    return ids if b"".join([spelled[k] for k in array("I", ids)]) == text else b""


def _ids(texts: list[bytes], side: First | Second) -> list[bytes | None]:
    """Ids of each text as little-endian 32-bit integers; None where the bytes of its tokens do not join to it."""
    cut = [side.cut(t) for t in texts]
    known = side.cache.lookup(set().union(*cut)).__getitem__
    found = [list(map(known, parts)) for parts in cut]
    return [b"".join(v) if all(v) else None for v in found]


@functools.lru_cache(maxsize=4)
def _first(path: str) -> First:
    return First(path)


@functools.lru_cache(maxsize=4)
def _second(path: str) -> Second:
    return Second(path)


_CUT = re.compile(rb"(?<=[!-~])(?= )")


def stretches(text: bytes) -> Iterator[bytes]:
    """The text cut before blanks that follow a printed ASCII character, where tokens of either kind end."""
    start = 0
    while len(text) - start > STRETCH_BYTES:
        m = _CUT.search(text, start + STRETCH_BYTES)
        if m is None:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


class Aligned:
    """What a document's stretches add up to."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest, self.codes, self.times, self.good = None, [], [], True

    def pairs(self):
        """Distinct id pairs, ascending, and how many links each has."""
        import numpy as np

        if not self.good or not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.codes) == 1:
            return self.codes[0], self.times[0]
        codes, back = np.unique(np.concatenate(self.codes), return_inverse=True)
        times = np.zeros(len(codes), np.int64)
        np.add.at(times, back, np.concatenate(self.times))
        return codes, times


@functools.lru_cache(maxsize=2)
def _spelled(n: int) -> list[bytes]:
    """Decimal ids with what can follow each: a comma, a bar, a semicolon."""
    return [b"%d%c" % (k, c) for c in b",|;" for k in range(n)]


def _together(owners: list[int], ids_a: list[bytes], ids_b: list[bytes], a: First, b: Second, docs: list[Aligned]) -> None:
    """Align the stretches of a batch, one after another, and add them to their documents."""
    import numpy as np

    x, y = np.frombuffer(b"".join(ids_a), "<u4").astype(np.int64), np.frombuffer(b"".join(ids_b), "<u4").astype(np.int64)
    end_x, end_y = np.cumsum(a.size[x]), np.cumsum(b.size[y])
    i, j = shared_cuts(end_x, end_y)
    cut_x, cut_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    cut_x[i] = cut_y[j] = True
    group_x, group_y = np.cumsum(cut_x) - cut_x, np.cumsum(cut_y) - cut_y
    # places of all tokens with those of A before those of B in each group, and what is written there
    before_x = np.searchsorted(group_y, group_x, "left")
    before_y = np.searchsorted(group_x, group_y, "right")
    written_ids = np.zeros(len(x) + len(y), np.int64)
    most = max(len(a.size), len(b.size))
    written_ids[np.arange(len(x)) + before_x] = x + most * cut_x
    written_ids[np.arange(len(y)) + before_y] = y + 2 * most * cut_y
    text = _spelled(most)
    # links: the tokens of B that end after a token of A starts and start before it ends
    start_x, start_y = end_x - a.size[x], end_y - b.size[y]
    low, high = np.searchsorted(end_y, start_x, "right"), np.searchsorted(start_y, end_x, "left")
    n = np.maximum(high - low, 0)
    at = np.repeat(np.arange(len(x)), n)
    codes = (x[at] << BITS) | y[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    bounds_x = np.cumsum([0, *[len(v) // 4 for v in ids_a]]).tolist()
    bounds_y = np.cumsum([0, *[len(v) // 4 for v in ids_b]]).tolist()
    links = np.concatenate([[0], np.cumsum(n)])
    groups = np.concatenate([[0], np.cumsum(cut_x)])
    places = written_ids.tolist()
    for k, owner in enumerate(owners):
        d = docs[owner]
        x0, x1, y0, y1 = bounds_x[k], bounds_x[k + 1], bounds_y[k], bounds_y[k + 1]
        if x0 == x1:
            continue
        d.n_a, d.n_b, d.n_groups, d.n_links = d.n_a + x1 - x0, d.n_b + y1 - y0, d.n_groups + int(groups[x1] - groups[x0]), d.n_links + int(links[x1] - links[x0])
        part = b"".join(map(text.__getitem__, places[x0 + y0 : x1 + y1]))[:-1]
        if d.digest is None:
            d.digest = hashlib.sha256(part)
        else:
            d.digest.update(b";" + part)
        c, t = np.unique(codes[links[x0] : links[x1]], return_counts=True)
        d.codes.append(c)
        d.times.append(t)


def align(texts: list[bytes], path_a: str, path_b: str) -> list[Aligned]:
    """Each text with its groups and links; one whose tokens do not join to blank + text has none."""
    a, b = _first(path_a), _second(path_b)
    docs = [Aligned() for _ in texts]
    parts = [(k, p) for k, t in enumerate(texts) if t for p in (stretches(b" " + t) if not b.whole else [b" " + t])]
    numbers = iter(parts)
    for batch in balanced([p for _, p in parts], BATCH_BYTES):
        owners = [next(numbers)[0] for _ in batch]
        got = [(k, p, q) for k, p, q in zip(owners, _ids(batch, a), _ids(batch, b), strict=True)]
        for k, p, q in got:
            docs[k].good &= p is not None and q is not None
        got = [g for g in got if docs[g[0]].good]
        if got:
            _together([g[0] for g in got], [g[1] for g in got], [g[2] for g in got], a, b, docs)
    return docs


def _aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """Of every row the figures that need no other document, and its distinct pairs with their numbers of links."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType()),
    ])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            at = 0
            for group in balanced(texts, 4 * BATCH_BYTES):
                found = align(group, path_a, path_b)
                good = [d if d.good else Aligned() for d in found]
                pairs = [d.pairs() for d in good]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(group)),
                        *[pa.array([getattr(d, c) for d in good], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array([d.digest.hexdigest() if d.digest else "" for d in good], pa.string()),
                        pa.array([c.astype("<u8").tobytes() for c, _ in pairs], pa.binary()),
                        pa.array([t.astype("<u4").tobytes() for _, t in pairs], pa.binary()),
                    ],
                    names=schema.names,
                )
                at += len(group)

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``code, a, n, best`` of every linked id pair: ``n`` documents hold it, and ``best`` if no pair of its A id is held by more."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        codes, n, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

        for b in batches:
            held += [np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()]
            size += sum(map(len, held[-b.num_rows :]))
            if size < HELD_PAIRS:
                continue
            codes, n = _added(codes, n, held)
            held, size = [], 0
            if len(codes) > HELD_PAIRS:
                yield out()
                codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, n = _added(codes, n, held)
        yield out()

    counted = aligned.select("pairs").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counted = written(counted.withColumn("a", F.shiftright("code", BITS)), "pair-counts")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of A's vocabulary
    return counted.join(F.broadcast(most), "a").select("code", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def _added(codes, n, held: list):
    """Counts of the distinct codes with one more for each time that a list of ``held`` has it."""
    import numpy as np

    more, times = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
    every, back = np.unique(np.concatenate([codes, more]), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, back, np.concatenate([n, times]))
    return every, total


def _scored(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` raised by the links of ``pairs``, PAIRS_AT_ONCE of them at about."""
    import numpy as np

    t = pairs.select("code", "n", "best").toArrow()  # about PAIRS_AT_ONCE rows
    code, n, best = (t.column(c).to_numpy() for c in ("code", "n", "best"))
    order = np.argsort(code)
    shared = pairs.sparkSession.sparkContext.broadcast((code[order], n[order], best[order].astype(bool)))
    names = aligned.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codes, counts, best = shared.value
        for b in batches:
            column = {c: b.column(i) for i, c in enumerate(names)}
            own = [np.frombuffer(x, "<i8") for x in column["pairs"].to_pylist()]
            size = np.array([len(x) for x in own], np.int64)
            all_codes = np.concatenate([np.zeros(0, np.int64), *own])
            times = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, "<u4") for x in column["times"].to_pylist()]]).astype(np.int64)
            at = np.minimum(np.searchsorted(codes, all_codes), max(0, len(codes) - 1))
            there = codes[at] == all_codes if len(codes) else np.zeros(len(all_codes), bool)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (np.where(there & best[at], times, 0), np.where(there, times * counts[at], 0))] if len(codes) else [np.zeros(len(all_codes) + 1, np.int64)] * 2
            end = np.cumsum(size)
            for name, s in zip(("n_best", "count_sum"), sums, strict=True):
                column[name] = pa.array(column[name].to_numpy() + s[end] - s[end - size])
            yield pa.RecordBatch.from_arrays(list(column.values()), names=names)

    return aligned.mapInArrow(run, aligned.schema)


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``path_a`` is a byte-level file of the ``tokenizers`` library, run on blank + text with the strings of special tokens as
    ordinary text; ``path_b`` a ``sentencepiece`` model, run on the text.  Ends that both share cut the tokens into groups;
    every A-B pair of occurrences with bytes in common is a link; an id pair counts as many documents as hold it linked.
    ``n_best`` are the links whose count is the highest of their A id (ties included), ``count_sum`` adds the counts up over
    the links, ``groups_sha256`` is the digest of the groups written as ``a1,a2|b1;a3|b2,b3``.  A null or empty text, and
    one whose tokens do not join to blank + text, has no tokens: zeros and an empty digest.  Each repeated row is a
    document of its own; null ids keep their rows; an empty table gives none; other columns are not read.
    """
    found = written(_aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    pairs = written(pair_counts(found), "pairs")
    slices = max(1, -(-pairs.count() // PAIRS_AT_ONCE))
    scored = found.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for k in range(slices):  # each slice of the pairs adds its share
        scored = _scored(scored, pairs.filter(F.pmod(F.xxhash64("code"), F.lit(slices)) == k))
        if k + 1 < slices:
            scored = written(scored, "scored")
    return scored.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
