"""Queries of the training-data operators over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, decontaminate, hard_negatives, language_id, lm_score, mixing, quality_rules, simhash, token_count, token_output, toxicity, url_filter, warc_revisit
from .common import fold, prepare, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return keep


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op2_token_output")
def op2(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    path = scratch_path(spark, "token-ids")
    token_output.write_token_ids(table(spark, d, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_output.read_token_ids(spark, path)


@register("op3_token_counts")
def op3(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return token_count.token_counts(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"))


#: (host, path prefix, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@register("op6_url_filter")
def op6(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).drop("url")


ORACLES["op6_url_filter"] = """
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
d AS (SELECT DISTINCT host, path FROM u),
m AS (
  SELECT d.host, d.path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM d JOIN r ON (d.host = h OR suffix(d.host, '.' || h)) AND starts_with(d.path, p) GROUP BY d.host, d.path)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.host = m.host AND u.path = m.path
"""


@register("op8_decontamination")
def op8(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op8_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, w[i : i + least(10, len(w)) - 1] AS words, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT r, i, n, w[i : i + n - 1] AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, spots.n, item FROM spots JOIN win ON spots.words = win.words),
n_hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)
"""


@register("op10_simhash")
def op10(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


@register("op9_quality_rules")
def op9(spark: SparkSession, d: str) -> DataFrame:
    found = quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    return found.drop("n_lines", "n_distinct")


@register("op5_mixing")
def op5(spark: SparkSession, d: str) -> DataFrame:
    found = mixing.mix(table(spark, d, "documents").select("doc_id", "text", "source", "lang"))
    return found.select("doc_id", "source", "lang", "topic", "tokens", F.round(F.col("probability"), 6).alias("probability"), "sampled")


SQL_SWEEPS = 25  # written out; the given tables need fewer


def _mixing_sql() -> str:
    """The raking written out: every sweep three small tables, then the scale of the budget."""
    a = mixing.ALPHA
    ctes = [
        r"""x AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, coalesce(text, '') AS text,
  coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, ''))) AS draw, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents)""",
        r"""d AS MATERIALIZED (SELECT doc_id, source, lang, s, l, tokens, draw,
  CASE WHEN (length(text) - length(translate(text, '#*$%&|<>', ''))) * 10 >= greatest(tokens, 1) THEN 'marked'
    WHEN tokens < 100 THEN 'brief' WHEN tokens < 1000 THEN 'prose' ELSE 'long' END AS topic FROM x)""",
        "c0 AS MATERIALIZED (SELECT s, l, topic AS t, sum(tokens)::DOUBLE AS m FROM d GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for k, n in (("s", "source"), ("l", "lang"), ("t", "topic")):
        ctes.append(f"p{k} AS (SELECT {k}, pow(sum(m) / (SELECT sum(m) FROM c0), {a[n]}) AS w FROM c0 GROUP BY {k})")
        ctes.append(f"w{k} AS MATERIALIZED (SELECT {k}, w / (SELECT sum(w) FROM p{k}) AS w FROM p{k})")
    ctes += ["fl0 AS (SELECT l, 1.0::DOUBLE AS f FROM wl)", "ft0 AS (SELECT t, 1.0::DOUBLE AS f FROM wt)"]
    fit = "SELECT s, l, t, m, ws.w * fl.f * ft.f / sum(m * fl.f * ft.f) OVER (PARTITION BY s) AS w FROM c0 JOIN ws USING (s) JOIN fl{i} fl USING (l) JOIN ft{i} ft USING (t)"
    for i in range(SQL_SWEEPS):
        ctes += [
            f"j{i} AS MATERIALIZED (SELECT l, t, sum(m * w) AS m FROM ({fit.format(i=i)}) GROUP BY l, t)",
            f"u{i} AS MATERIALIZED (SELECT l, any_value(wl.w) / sum(m) AS u FROM j{i} JOIN wl USING (l) GROUP BY l)",
            f"fl{i + 1} AS MATERIALIZED (SELECT l, f * u AS f FROM fl{i} JOIN u{i} USING (l))",
            f"ft{i + 1} AS MATERIALIZED (SELECT t, any_value(f) * any_value(wt.w) / sum(m * u) AS f FROM j{i} JOIN u{i} USING (l) JOIN wt USING (t) JOIN ft{i} USING (t) GROUP BY t)",
        ]
    ctes.append(f"c AS MATERIALIZED ({fit.format(i=SQL_SWEEPS)})")
    ctes.append(
        f"""r AS (SELECT w, ({mixing.BUDGET} * sum(m) OVER () - coalesce(sum(m) OVER (ORDER BY w DESC, s, l, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(m * w) OVER (ORDER BY w DESC, s, l, t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM c)"""
    )
    ctes.append("k AS (SELECT arg_max(scale, w) AS scale FROM r WHERE scale * w < 1)")
    ctes.append(
        """o AS (SELECT d.*, CASE WHEN d.tokens = 0 THEN 1.0 ELSE least(1.0, w * (SELECT scale FROM k)) END AS p
  FROM d LEFT JOIN c ON d.s = c.s AND d.l = c.l AND d.topic = c.t)"""
    )
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, source, lang, topic, tokens::BIGINT AS tokens, round(p, 6) AS probability,
  ('0x' || substr(md5(draw || ':{mixing.SEED}'), 1, 13))::BIGINT / 4503599627370496.0 < p AS sampled FROM o"""


ORACLES["op5_mixing"] = _mixing_sql()


@register("op7_toxicity")
def op7(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, d, "documents").select("doc_id", "text")
    scorer = toxicity.fit(docs, table(spark, d, "labels"))
    found, _ = toxicity.score(docs, scorer, keep=["doc_id"])
    held_out = fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.transform("evidence", lambda e: e["id"]).alias("evidence"))


def captures(pages: DataFrame) -> DataFrame:
    """Web captures made from ``pages``: each page's full response, checks of it by 304 under other spellings of
    its url, and for some pages a changed response, checks without or with stale validators, and one too early."""
    k, day = F.col("page_id"), 86400
    begin = F.lit(1_704_067_200) + F.pmod(k, F.lit(1000)) * 3600
    tag = lambda version: F.concat(F.lit('"'), F.md5(F.concat("html", F.lit(version)).cast("binary")), F.lit('"'))
    when = lambda days: F.concat(F.lit("day "), (F.floor(begin / day) + days).cast("string"))
    bare = F.regexp_replace("url", "#.*$", "")
    tracked = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_source=recrawl#checked"))

    def capture(name: str, days: int, status: int, url, headers: dict, only=None):
        entries = F.map_from_entries(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(n).alias("key"), v.cast("string").alias("value"))) for n, v in headers.items()])))
        row = F.struct(F.concat(k.cast("string"), F.lit("-" + name)).alias("record_id"), url.alias("url"), (begin + days * day).alias("time"), F.lit(status).alias("status"), entries.alias("headers"))
        return row if only is None else F.when(only, row)

    size = F.length("html")
    answers = F.array_compact(F.array(
        capture("a", 0, 200, F.col("url"), {"ETag": tag(""), "Last-Modified": when(0), "Content-Type": F.lit("text/html"), "Content-Length": size, "Cache-Control": F.lit("max-age=60"), "Date": when(0)}),
        capture("b", 1, 304, tracked, {"etag": F.concat(F.lit("W/"), F.when(k % 7 == 3, tag("stale")).otherwise(tag(""))), "Cache-Control": F.lit("max-age=120"), "Content-Length": F.lit(0), "Date": when(1)}),
        capture("c", 2, 200, F.col("url"), {"ETag": tag("2"), "Last-Modified": when(2), "Content-Type": F.lit("text/html"), "Content-Length": size + 1, "Date": when(2)}, k % 3 == 0),
        capture("d", 3, 304, bare, {"Last-Modified": F.when(k % 5 != 0, F.when(k % 3 == 0, when(2)).otherwise(when(0))), "Expires": when(9), "Transfer-Encoding": F.lit("chunked"), "Date": when(3)}),
        capture("e", -1, 304, F.col("url"), {"ETag": tag(""), "Date": when(-1)}, k % 11 == 0),
    ))
    return pages.select(F.explode(answers).alias("r")).select("r.*")


@register("op4_warc_revisits")
def op4(spark: SparkSession, d: str) -> DataFrame:
    found = warc_revisit.resolve_revisits(captures(table(spark, d, "pages").select("page_id", "url", "html")))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select("record_id", "canonical_url", "response_id", "outcome", F.array_join(pairs, ";").alias("headers"))


ORACLES["op4_warc_revisits"] = r"""
WITH p AS (
  SELECT page_id AS k, url, 1704067200 + (page_id % 1000) * 3600 AS t0, html, length(html) AS size,
    regexp_replace(url, '#.*$', '') AS bare FROM pages),
q AS (
  SELECT *, '"' || md5(html) || '"' AS tag, '"' || md5(html || '2') || '"' AS tag2, '"' || md5(html || 'stale') || '"' AS stale,
    t0 // 86400 AS day, bare || CASE WHEN contains(bare, '?') THEN '&' ELSE '?' END || 'utm_source=recrawl#checked' AS tracked FROM p),
c AS (
  SELECT k || '-a' AS id, url, t0 AS t, true AS is_full, [{'k': 'etag', 'v': tag}, {'k': 'last-modified', 'v': 'day ' || day}, {'k': 'content-type', 'v': 'text/html'},
    {'k': 'content-length', 'v': size::VARCHAR}, {'k': 'cache-control', 'v': 'max-age=60'}, {'k': 'date', 'v': 'day ' || day}] AS h FROM q
  UNION ALL SELECT k || '-b', tracked, t0 + 86400, false, [{'k': 'etag', 'v': 'W/' || CASE WHEN k % 7 = 3 THEN stale ELSE tag END}, {'k': 'cache-control', 'v': 'max-age=120'},
    {'k': 'content-length', 'v': '0'}, {'k': 'date', 'v': 'day ' || (day + 1)}] FROM q
  UNION ALL SELECT k || '-c', url, t0 + 2 * 86400, true, [{'k': 'etag', 'v': tag2}, {'k': 'last-modified', 'v': 'day ' || (day + 2)}, {'k': 'content-type', 'v': 'text/html'},
    {'k': 'content-length', 'v': (size + 1)::VARCHAR}, {'k': 'date', 'v': 'day ' || (day + 2)}] FROM q WHERE k % 3 = 0
  UNION ALL SELECT k || '-d', bare, t0 + 3 * 86400, false, list_filter([{'k': 'last-modified', 'v': CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN 'day ' || (day + 2) ELSE 'day ' || day END},
    {'k': 'expires', 'v': 'day ' || (day + 9)}, {'k': 'transfer-encoding', 'v': 'chunked'}, {'k': 'date', 'v': 'day ' || (day + 3)}], lambda x: x.v IS NOT NULL) FROM q
  UNION ALL SELECT k || '-e', url, t0 - 86400, false, [{'k': 'etag', 'v': tag}, {'k': 'date', 'v': 'day ' || (day - 1)}] FROM q WHERE k % 11 = 0),
u AS (
  SELECT *, regexp_extract(url, '^[^:/?#]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['host', 'path', 'query']) AS x, regexp_matches(url, '^[^:/?#]*://') AS has FROM c),
v AS (
  SELECT id, t, is_full, h, CASE WHEN has THEN
    regexp_replace(translate(x.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.|:(80|443)$', '', 'g')
    || CASE WHEN x.path = '' THEN '/' ELSE x.path END
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(x.query, '&'),
      lambda y: y <> '' AND split_part(y, '=', 1) NOT IN ('fbclid', 'gclid', 'ref') AND NOT starts_with(split_part(y, '=', 1), 'utm_'))), '&'), ''), '') END AS canon
  FROM u),
f AS (SELECT canon, t, max(id) AS id, arg_max(h, id) AS h FROM v WHERE is_full AND canon IS NOT NULL GROUP BY canon, t),
j AS (SELECT v.id, v.canon, v.h, f.id AS rid, f.h AS rh FROM (SELECT * FROM v WHERE NOT is_full) v ASOF LEFT JOIN f ON v.canon = f.canon AND v.t > f.t),
o AS (
  SELECT *, replace(list_filter(h, lambda x: x.k = 'etag')[1].v, 'W/', '') AS et, list_filter(h, lambda x: x.k = 'last-modified')[1].v AS lm,
    list_filter(rh, lambda x: x.k = 'etag')[1].v AS ret, list_filter(rh, lambda x: x.k = 'last-modified')[1].v AS rlm,
    list_filter(h, lambda x: x.k NOT IN ('content-length', 'transfer-encoding')) AS allowed FROM j),
z AS (
  SELECT *, CASE WHEN canon IS NULL THEN 'no_url' WHEN rid IS NULL THEN 'no_response'
    WHEN et IS NOT NULL THEN CASE WHEN et = ret THEN 'resolved' ELSE 'mismatch' END
    WHEN lm IS NOT NULL THEN CASE WHEN lm = rlm THEN 'resolved' ELSE 'mismatch' END ELSE 'no_validator' END AS outcome FROM o)
SELECT id AS record_id, canon AS canonical_url, CASE WHEN outcome = 'resolved' THEN rid END AS response_id, outcome,
  CASE WHEN outcome = 'resolved' THEN array_to_string(list_sort(list_transform(list_concat(
    list_filter(rh, lambda x: NOT list_contains(list_transform(allowed, lambda y: y.k), x.k)), allowed), lambda y: y.k || '=' || y.v)), ';') END AS headers
FROM z
"""


@register("op1_lm_score")
def op1(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return lm_score.lm_scores(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


@register("op11_hard_negatives")
def op11(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    rows = table(spark, d, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT r AS ar, id AS anchor, y AS ay, q AS aq FROM v WHERE id % 50 = 0),
s AS MATERIALIZED (SELECT ar, anchor, r, id, y = ay AS same, list_dot_product(aq, q)::BIGINT AS score FROM a, v),
p AS (
  SELECT * FROM (SELECT ar, anchor, r, id, score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id) AS k FROM s WHERE same AND r <> ar) WHERE k <= 5),
n AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id AS negative, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.r ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, negative AS negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@register("op13_language_id")
def op13(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, d, "documents")
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    held_out = (fold(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT).alias("held_out")
    return language_id.identify(docs.select("doc_id", held_out, "text"), model, keep=["doc_id", "held_out"])


@register("op12_alignment")
def op12(spark: SparkSession, d: str) -> DataFrame:
    prepare(spark)
    return alignment.alignments(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
