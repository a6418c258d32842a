"""URL filter: a sorted array of 64-bit digests, memory-mapped by the tasks.

The list's entries (host and path prefix joined) are kept as one file: the sorted XXH64 keys, the offset of
each entry's full string, its verdict, and the strings.  A task maps the file, makes the keys of all
entries that could fit a url (its host and parent domains, each with the path prefixes of the lengths that
occur in the list), finds them by vectorised binary search, and believes a hit only if the stored string is
the same.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, lower_ascii

#: Entries of one file at most (about 2 GB at 60 bytes each); a longer list is joined instead.
MAX_ENTRIES = 20_000_000
Rule = tuple[str, str, str]  # host, path prefix, verdict


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def write_digest_array(rules: Iterable[Rule], path: str, digest=None) -> None:
    """Write the list: header, keys, string offsets, verdicts, host lengths, strings.  ``digest`` is for tests of collisions."""
    import xxhash

    digest = digest or xxhash.xxh64_intdigest
    best: dict[bytes, tuple[str, int]] = {}
    for host, prefix, verdict in rules:
        best[(host + prefix).encode()] = (verdict, len(host.encode()))
    order = sorted((digest(k), k) for k in best)
    if len(order) > MAX_ENTRIES:
        raise ValueError(f"{len(order)} entries; a list of over {MAX_ENTRIES} is joined, see rules_by_join")
    names = [k for _, k in order]
    with open(path, "wb") as f:
        np.array([len(names)], "<u8").tofile(f)
        np.array([d for d, _ in order], "<u8").tofile(f)
        np.concatenate([[0], np.cumsum([len(k) for k in names], dtype=np.int64)]).astype("<u8").tofile(f)
        np.array([best[k][1] for k in names], "<u8").tofile(f)
        np.array([best[k][0] == "allow" for k in names], "u1").tofile(f)
        f.write(b"".join(names))


class DigestArray:
    """The mapped file: nothing but the pages that probes touch is read."""

    def __init__(self, path: str, digest=None) -> None:
        import xxhash

        self.digest = digest or xxhash.xxh64_intdigest
        n = int(np.fromfile(path, "<u8", 1)[0])
        at = 8
        shape = lambda kind, size: np.memmap(path, kind, "r", at, (size,)) if size else np.zeros(0, kind)
        self.keys = shape("<u8", n)
        at += 8 * n
        self.offsets = shape("<u8", n + 1)
        at += 8 * (n + 1)
        self.host_bytes = shape("<u8", n)
        at += 8 * n
        self.allows = shape("u1", n)
        at += n
        self.strings = shape("u1", os.path.getsize(path) - at)
        sizes = np.diff(np.asarray(self.offsets).astype(np.int64))
        hosts = np.asarray(self.host_bytes).astype(np.int64)
        self.path_lengths = np.unique(sizes - hosts).tolist()
        self.longest_host = int(hosts.max()) if n else 0

    def string(self, i: int) -> bytes:
        return self.strings[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes()

    def candidates(self, host: bytes, path: bytes) -> list[bytes]:
        """Strings that an entry fitting this url could be: only as long as the list's entries are."""
        names, at = [], 0
        if len(host) > self.longest_host:
            at = host.find(b".", len(host) - self.longest_host - 1) + 1
            if not at:
                return []
        while host:
            names.append(host[at:])
            at = host.find(b".", at) + 1
            if not at:
                break
        return [x + path[:n] for x in names for n in self.path_lengths if n <= len(path)]

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """Index of the entry that each string is; -1 if none is."""
        out = np.full(len(wanted), -1, dtype=np.int64)
        if not wanted or not len(self.keys):
            return out
        keys = np.fromiter(map(self.digest, wanted), np.uint64, len(wanted))
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys).tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == keys[i]:  # all entries of the same digest
                if self.string(k) == wanted[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def match(self, hosts: list[bytes], paths: list[bytes]) -> list[int]:
        """For each url the index of the longest entry that fits, or -1."""
        wanted, owner = [], []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            own = self.candidates(h, p)
            wanted += own
            owner += [i] * len(own)
        best = [-1] * len(hosts)
        for i, k, name in zip(owner, self.find(wanted).tolist(), wanted, strict=True):
            if k >= 0 and (best[i] < 0 or len(name) > len(self.string(best[i]))):
                best[i] = k
        return best


def filter_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` of each row's url.

    A rule (host, path prefix, allow or block) fits its host and all subdomains if the url's path starts
    with its path; of those that fit, the one of most bytes wins, of equal ones that of the longer host; of rules given twice the last counts.  Without
    one, ``rule`` is null and ``verdict`` is ``default``: a url that the list does not name passes.  A null
    url, or one without ``://``, has empty host and path and fits no rule.  A column of the input that
    has one of the four names is kept and the new one gets underscores before its name.
    The list is sent to each executor as one file (``MAX_ENTRIES`` bounds it; :func:`rules_by_join` is
    the way for longer ones).
    """
    spark = pages.sparkSession
    if len(rules) > MAX_ENTRIES:
        numbered = [(n, *r) for n, r in enumerate(rules)]
        return rules_by_join(pages, spark.createDataFrame(numbered, "n long, host string, prefix string, verdict string"), url_col, default)
    name = f"urls-{uuid.uuid4().hex}.digests"
    # The driver's own file: Spark serves it from here and copies it to where each executor works.
    own = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="carelake-urls-")), name)
    write_digest_array(rules, own)
    spark.sparkContext.addFile(own)
    names = [fresh(pages, c) for c in ("host", "path", "rule", "verdict")]
    full = pages.withColumns({names[0]: host_of(F.col(url_col)), names[1]: path_of(F.col(url_col))})
    schema = T.StructType([*full.schema.fields, T.StructField(names[2], T.StringType()), T.StructField(names[3], T.StringType())])

    def probe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        array = DigestArray(SparkFiles.get(name))
        for b in batches:
            hosts, paths = (b.column(c).cast(pa.binary()).to_pylist() for c in names[:2])
            found = array.match(hosts, paths)
            rule = pa.array([None if k < 0 else array.string(k).decode() for k in found], pa.string())
            verdict = pa.array([default if k < 0 else "allow" if array.allows[k] else "block" for k in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=[*b.schema.names, *names[2:]])

    return full.mapInArrow(probe, schema)


def rules_by_join(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same verdicts for a list too long for one file, a table ``n, host, prefix, verdict`` that may come from anywhere:
    candidate strings are joined with it by equality.  ``n`` orders the rules, so that of one given twice the last counts; a table
    without it has no order, so there a block counts before an allow."""
    host, path, rule, verdict, own_host, own_path, found_verdict = (fresh(pages, c) for c in ("host", "path", "rule", "verdict", "url_host", "url_path", "found_verdict"))
    sizes = [r[0] for r in rules.select(F.length("prefix")).distinct().collect()] or [0]
    full = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    # distinct urls are matched once: a url on a third of the pages is one row here
    urls = full.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    prefixes = F.array_compact(F.array(*[F.when(F.length("p") >= n, F.substring("p", 1, n)) for n in sizes]))
    wanted = urls.withColumn("parent", F.explode(parents_of("h"))).withColumn("prefix", F.explode(prefixes))
    last = F.max_by("verdict", "n") if "n" in rules.columns else F.max("verdict")
    listed = rules.groupBy(F.concat("host", "prefix").alias("rule")).agg(last.alias("verdict"))
    found = (
        wanted.withColumn("rule", F.concat("parent", "prefix"))
        .join(listed, "rule")
        .groupBy("h", "p")
        .agg(F.max(F.struct(F.octet_length("rule").alias("n"), F.octet_length("parent").alias("of"), "rule", "verdict")).alias("best"))
        .select(F.col("h").alias(own_host), F.col("p").alias(own_path), F.col("best.rule").alias(rule), F.col("best.verdict").alias(found_verdict))
    )
    joined = full.join(found, (full[host] == found[own_host]) & (full[path] == found[own_path]), "left")
    return joined.select(*[full[c] for c in full.columns], found[rule], F.coalesce(found[found_verdict], F.lit(default)).alias(verdict))


def parents_of(host: str) -> Column:
    """The host and each parent domain."""
    labels = F.split(F.col(host), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
