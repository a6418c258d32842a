"""Resolution of not-modified (304) web captures to the full response they confirm.

An as-of join: for each revisit the latest earlier full response of the same canonical url.  Records are dealt out
by ranges of (url, time), so that the captures of one very common url spread over many tasks; within a
part a window carries the last full response forward, and a part that begins inside a url gets what the
parts before it carried, one small row for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, written

# Header fields that a 304 response must not change in the stored response.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
# Query parameters that only track where a visitor came from.
TRACKING = ["fbclid", "gclid", "ref"]
TRACKING_PREFIX = "utm_"


def canonical_url(url: Column) -> Column:
    """Host, path and query in one form: no scheme, user, ``www.``, default port, fragment or tracking
    parameters; host lower-case, path at least ``/``, parameters sorted.  Null if there is no ``://``."""
    parts = "^[^:/?#]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\\?([^#]*))?"
    host = F.regexp_replace(lower_ascii(F.regexp_extract(url, parts, 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_extract(url, parts, 2)
    name = lambda x: F.substring_index(x, "=", 1)
    query = F.array_sort(F.filter(
        F.split(F.regexp_extract(url, parts, 3), "&"),
        lambda x: (x != "") & ~name(x).isin(TRACKING) & ~name(x).startswith(TRACKING_PREFIX),
    ))
    whole = F.concat(host, F.when(path == "", "/").otherwise(path), F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(url.rlike("^[^:/?#]*://"), whole)


def lower_names(headers: Column) -> Column:
    """The headers with lower-case names; of names that differ in case alone the first counts.  Null: none."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.get(F.filter(entries, lambda e: F.lower(e["key"]) == n), F.lit(0))["value"]))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored response's headers with the permitted ones of the 304 in place of its own."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(NOT_MERGED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k)), allowed)


def resolve_revisits(
    records: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "time", status_col: str = "status", headers_col: str = "headers"
) -> DataFrame:
    """One row per record of status 304: ``id_col, canonical_url, response_id, outcome, headers``.

    Full responses are records of status 200 to 299; other records play no part.  The response is the latest with a
    strictly earlier time at the same canonical url, of several at one time the one of the largest id.
    ``outcome``: ``resolved`` if the 304's ETag (compared weakly) or, where it has none, its Last-Modified
    equals the response's; ``mismatch`` if not; ``no_validator`` if it has neither; ``no_response`` if there is no
    earlier response; ``no_url`` or ``no_time`` if these are null.  ``response_id`` and ``headers`` (merged, names
    lower-case) are null unless resolved.  Repeated rows each give their row; a null id is an id like any
    other and the smallest in a tie; null headers are none; an empty table gives none; other columns are not read.
    """
    h = lower_names(F.col(headers_col))
    full = F.col(status_col).between(200, 299)
    own = records.filter(full | (F.col(status_col) == 304)).select(
        F.col(id_col).alias("id"), canonical_url(F.col(url_col)).alias("url"), F.col(time_col).alias("time"),
        F.coalesce(full, F.lit(False)).cast("int").alias("full"), h.alias("h"),
    )
    usable = F.col("url").isNotNull() & F.col("time").isNotNull()
    # a revisit stands before the responses of its own time, so that it sees earlier ones alone
    ranged = own.filter(usable).repartitionByRange("url", "time", "full", "id").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "captures")
    order = ["time", "full", "id"]
    response = F.when(F.col("full") == 1, F.struct("time", "id", "h"))
    inside = Window.partitionBy("part", "url").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumn("found", F.last(response, ignorenulls=True).over(inside)).filter("full = 0")
    # urls that more than one part holds: each part has two such at most, its first and its last
    ends = ranged.groupBy("url", "part").agg(F.max_by(response, F.when(F.col("full") == 1, F.struct("time", "id"))).alias("last"))
    spans = ranged.groupBy("url").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("url")
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.join(spans, "url", "left_semi").withColumn("carried", F.last("last", ignorenulls=True).over(earlier)).filter("carried is not null")
    carried = carried.select(F.col("url").alias("_url"), F.col("part").alias("_part"), "carried")
    found = filled.join(F.broadcast(carried), (F.col("url") == F.col("_url")) & (F.col("part") == F.col("_part")), "left")
    found = found.select("id", "url", "time", "h", F.coalesce("found", "carried").alias("r"))
    rest = own.filter(~usable & (F.col("full") == 0)).withColumn("r", F.lit(None).cast(found.schema["r"].dataType))
    found = found.unionByName(rest.select("id", "url", "time", "h", "r"))
    tag = lambda c: F.regexp_replace(F.get(F.filter(F.array(F.element_at(c, "etag")), lambda x: x.isNotNull()), F.lit(0)), "^W/", "")
    since = lambda c: F.element_at(c, "last-modified")
    outcome = (
        F.when(F.col("url").isNull(), "no_url").when(F.col("time").isNull(), "no_time").when(F.col("r").isNull(), "no_response")
        .when(tag(F.col("h")).isNotNull(), F.when(tag(F.col("h")).eqNullSafe(tag(F.col("r.h"))), "resolved").otherwise("mismatch"))
        .when(since(F.col("h")).isNotNull(), F.when(since(F.col("h")).eqNullSafe(since(F.col("r.h"))), "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    found = found.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return found.select(
        F.col("id").alias(id_col), F.col("url").alias("canonical_url"), F.when(ok, F.col("r.id")).alias("response_id"), "outcome",
        F.when(ok, merged_headers(F.col("r.h"), F.col("h"))).alias("headers"),
    )
