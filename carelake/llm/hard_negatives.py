"""Hard negatives by exact inner product with LEMP-style coordinate pruning.

Vectors are packed, in order of length, into buckets of bounded size that hold the vectors and, for each coordinate, the
list of its values in sorted order.  With a threshold t for the inner product, an anchor q and a bucket whose longest
vector has length l, a vector of the bucket can only qualify if its direction p has cosine t / (|q| l) or more;
then each coordinate of p lies in a feasible range, an interval around q_f * cosine.  The ranges of
the anchor's focus coordinates, the largest of its direction, are looked up in the sorted lists and intersected; what is left
is verified by exact inner products.  A bucket whose bound lies under the threshold is skipped.

Thresholds rise as buckets are met, longest vectors first.  Anchors come in blocks of bounded size, each
broadcast and run against all buckets.  Inner products are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

BUCKET = 4096  # vectors of a bucket at most
ANCHORS = 16_384  # anchors broadcast at once, about
FOCUS = 4  # coordinates whose feasible ranges are intersected
LIMIT = 1 << 28  # components are held within this, so that products stay exact in 64 bits
PACKED = "bucket long, n int, dims int, ids binary, labels binary, marks binary, vectors binary, orders binary"
ANCHOR = "uid long, id long, label long, vector binary"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double, as longs within ``LIMIT``; null if any is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = vector.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), F.floor(v * scale).cast("double"))).cast("long")))


def pack(rows: DataFrame) -> DataFrame:
    """Buckets of ``id long, label long, vector array<long>, mark boolean``: ranges of length, dealt so that ties spread too."""
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    own = rows.select("id", "label", "vector", "mark", norm.alias("norm"))
    # equal lengths are told apart by id and vector; a vector that very many rows repeat is dealt out by a salt
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(BUCKET))
    own = written(own.withColumn("salt", salt), "vectors")
    dealt = own.repartitionByRange(F.desc("norm"), "id", "salt").sortWithinPartitions(F.desc("norm"), "id", "salt")

    def buckets(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def bucket(t):
            dims = max(1, *(len(v) for v in t.column(2)))
            m = np.zeros((t.num_rows, dims), np.int64)
            for i, v in enumerate(t.column(2)):
                m[i, : len(v)] = v.values.to_numpy()
            orders = np.argsort(m.T, axis=1, kind="stable").astype("<u2")
            ids, labels, marks = (t.column(c).to_numpy() for c in (0, 1, 3))
            row = [(part << 32) + made, t.num_rows, dims, ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), marks.astype("u1").tobytes(), m.astype("<i4").tobytes(), orders.tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
            names = ["bucket", "n", "dims", "ids", "labels", "marks", "vectors", "orders"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, BUCKET - size))
                b, size = b.slice(BUCKET - size), size + held[-1].num_rows
                if size == BUCKET:
                    yield bucket(pa.Table.from_batches(held).combine_chunks())
                    made, held, size = made + 1, [], 0
        if size:
            yield bucket(pa.Table.from_batches(held).combine_chunks())

    return dealt.select("id", "label", "vector", "mark").mapInArrow(buckets, PACKED)


class Bucket:
    """One packed bucket; see :func:`pack`."""

    def __init__(self, bucket: int, n: int, dims: int, ids: bytes, labels: bytes, marks: bytes, vectors: bytes, orders: bytes) -> None:
        import numpy as np

        self.n, self.dims = n, dims
        self.ids, self.labels, self.marks = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), np.frombuffer(marks, "u1")
        self.m = np.frombuffer(vectors, "<i4").reshape(n, dims)
        self.orders = np.frombuffer(orders, "<u2").reshape(dims, n)
        self.uids = (bucket << 12) + np.arange(n)  # BUCKET is 2^12
        self.real = self.m.astype(float)
        length = np.sqrt((self.real**2).sum(axis=1))
        self.shortest, self.longest = float(length.min()), float(length.max())
        self.sorted = np.take_along_axis(self.m.T, self.orders.astype(np.int64), axis=1)

    def candidates(self, q, q_length: float, least: float, focus):
        """Rows whose inner product with ``q`` can reach ``least``: all (None), or those in every feasible range."""
        import numpy as np

        if least <= 0 or not q_length:
            return None
        if least > q_length * self.longest * (1 + 1e-9):
            return np.zeros(0, np.int64)
        cosine = min(1.0, least / (q_length * self.longest))
        rows = None
        for f in focus:
            if f >= self.dims:
                continue
            x = q[f] / q_length
            # a direction of cosine c or more to q has its coordinate in x * c' -+ sqrt((1 - c'^2)(1 - x^2)) for a c' from c to 1
            spread = float(np.sqrt((1 - cosine * cosine) * (1 - x * x)))
            low = -1.0 if x < -cosine else x * cosine - spread
            high = 1.0 if x > cosine else x * cosine + spread
            # from directions to components: a vector's length lies between the shortest and the longest of the bucket
            low = low * (self.longest if low < 0 else self.shortest) * (1 + (1e-9 if low < 0 else -1e-9)) - 1e-6
            high = high * (self.longest if high > 0 else self.shortest) * (1 + (1e-9 if high > 0 else -1e-9)) + 1e-6
            if rows is None:
                a, b = np.searchsorted(self.sorted[f], low, "left"), np.searchsorted(self.sorted[f], high, "right")
                if b - a < self.n:
                    rows = self.orders[f, a:b].astype(np.int64)
            else:
                v = self.m[rows, f]
                rows = rows[(v >= low) & (v <= high)]
            if rows is not None and not len(rows):
                break
        return rows

    def products(self, q, rows):
        """Exact inner products with ``q`` of the rows (None: all)."""
        import numpy as np

        d, x = min(len(q), self.dims), q.astype(float)
        if self.longest * float(np.sqrt(x @ x)) < 1 << 52:  # sums of integers that doubles hold exactly
            m = self.real if rows is None else self.real[rows]
            return np.rint(m[:, :d] @ x[:d]).astype(np.int64)
        m = self.m if rows is None else self.m[rows]
        return m[:, :d].astype(np.int64) @ q[:d]


def _best(score, ids, k: int):
    """Places of the k of highest score, ties by the smaller id."""
    import numpy as np

    if len(score) > 4 * k:
        near = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Search:
    """Running best lists of a block of anchors: for each anchor bands of score, for each band its k first rows.

    ``same`` asks for rows of the anchor's label, other than itself; else for those of other labels.
    """

    def __init__(self, anchors: list[tuple], bands: list[list[tuple[int, int]]], k: int, same: bool) -> None:
        import numpy as np

        self.k, self.same = k, same
        self.uid = [a[0] for a in anchors]
        self.label = [a[2] for a in anchors]
        self.q = [np.frombuffer(a[3], "<i4").astype(np.int64) for a in anchors]
        self.length = [float(np.sqrt((q.astype(float) ** 2).sum())) for q in self.q]
        self.focus = [np.argsort(-np.abs(q), kind="stable")[:FOCUS].tolist() for q in self.q]
        self.bands = bands
        none = np.zeros(0, np.int64)
        self.held = [[(none, none)] * len(b) for b in bands]  # scores and ids, best first
        self.least = [[low for low, _ in b] for b in bands]
        self.met = self.verified = 0

    def meet(self, bucket: Bucket) -> None:
        import numpy as np

        for i, bands in enumerate(self.bands):
            if not bands:
                continue
            self.met += bucket.n
            least = min(self.least[i])
            rows = bucket.candidates(self.q[i], self.length[i], least, self.focus[i])
            if rows is not None and not len(rows):
                continue
            score = bucket.products(self.q[i], rows)
            self.verified += len(score)
            rows = np.flatnonzero(score >= least) if rows is None else rows[score >= least]
            score = score[score >= least]
            right = (bucket.labels[rows] == self.label[i]) & (bucket.uids[rows] != self.uid[i]) if self.same else bucket.labels[rows] != self.label[i]
            rows, score = rows[right], score[right]
            ids = bucket.ids[rows]
            for j, (_, high) in enumerate(bands):
                fit = (score >= self.least[i][j]) & (score <= high)
                if not fit.any():
                    continue
                s, x = (np.concatenate(v) for v in zip(self.held[i][j], (score[fit], ids[fit]), strict=True))
                best = _best(s, x, self.k)
                self.held[i][j] = (s[best], x[best])
                if len(best) == self.k:
                    self.least[i][j] = int(s[best[-1]])


LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _run(packed: DataFrame, anchors: list[tuple], bands: list[list[tuple[int, int]]], k: int, same: bool) -> DataFrame:
    """``uid, band, id, score``: of each part of the buckets the k first rows of each anchor's bands."""
    shared = packed.sparkSession.sparkContext.broadcast((anchors, bands))  # about ANCHORS anchors

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        found = Search(*shared.value, k, same)
        for b in batches:
            for r in b.to_pylist():
                found.meet(Bucket(**r))
        for i, lists in enumerate(found.held):
            for j, (score, ids) in enumerate(lists):
                if len(score):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), found.uid[i])), pa.array(np.full(len(score), j, np.int32)), pa.array(ids), pa.array(score)], names=["uid", "band", "id", "score"])

    return packed.mapInArrow(search, "uid long, band int, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k first of each anchor and band with their ``rank``; each part gave k at most."""
    order = Window.partitionBy("uid", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(``scale`` * x) (held within 2^28); a score is the integer inner product.  Every row for which ``anchor``
    holds is an anchor; its positives are the first ``positives`` other rows of its label, higher scores first, ties by
    smaller id.  For each, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score come back, ranked from 1.

    Labels and ids are integers.  Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Of vectors of different lengths the missing components count as 0.  A repeated row is another row:
    it can be a positive of its copy, and each copy of an anchor is an anchor.  An empty table gives no rows; columns other than those named
    (and those ``anchor`` reads) are not read.
    """
    own = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), quantised(F.col(vector_col), scale).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("mark")
    )
    packed = written(pack(own.filter("id is not null and label is not null and vector is not null")), "buckets")

    def strip(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                k = Bucket(**r)
                at = np.flatnonzero(k.marks)
                yield pa.RecordBatch.from_arrays([pa.array(k.uids[at]), pa.array(k.ids[at]), pa.array(k.labels[at]), pa.array([k.m[i].tobytes() for i in at.tolist()], pa.binary())], names=["uid", "id", "label", "vector"])

    anchors = written(packed.mapInArrow(strip, ANCHOR), "anchors")
    blocks = max(1, -(-anchors.count() // ANCHORS))
    parts = []
    for block in range(blocks):
        picked = [tuple(r) for r in anchors.filter(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == block).orderBy("uid").collect()]
        near = written(_first(_run(packed, picked, [[(LOWEST, HIGHEST)]] * len(picked), positives, True), positives), "positives")
        chosen: dict[int, list] = {a[0]: [] for a in picked}
        for r in near.orderBy("uid", "rank").collect():  # ``positives`` rows an anchor
            chosen[r["uid"]].append((r["id"], r["score"]))
        bands = [[(-(-low * s // 100), high * s // 100) for _, s in chosen[a[0]]] for a in picked]
        bands = [b if any(lo <= hi for lo, hi in b) else [] for b in bands]
        found = _first(_run(packed, picked, bands, negatives, False), negatives)
        names = near.select("uid", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        whose = anchors.select("uid", F.col("id").alias("anchor_id"))
        parts.append(written(
            found.join(names, ["uid", "band"]).join(whose, "uid").select(
                "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            ),
            "negatives",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
