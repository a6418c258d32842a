"""Operators against brute force on small inputs, with nulls, blanks, ties, repeats, empty tables and clashing columns."""

import math
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from carelake.llm import common, decontaminate, encoding, lm_score, mixing, quality_rules, simhash, simple8b, token_count, token_output, toxicity, url_filter, vptree, warc_revisit
from carelake.llm.block_max import BlockMaxIndex
from carelake.llm.lattice import END, PieceLattice, load_pieces

D = "/root/testdata/sf0.001"
LONG = "long tail of words, " * 20_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a"), (2, "the QUICK brown fox jumps over the lazy dog. " * 3, "en", "a"), (3, None, None, None),
    (4, "", "fr", "b"), (5, " \t\n", "fr", "b"), (6, "one", "en", "a"), (7, "one two", "en", None), (8, LONG, "en", "a"), (8, LONG, "en", "a"),
    (None, "no id here at all", "de", "c"), (9, "Ünï cödé\u00a0text <|endoftext|> 日本 ### $$$", "de", "c"), (10, "x" * 5000, None, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    rows = [(*t, 0, -1.0, "mine", False) for t in TEXTS]
    # the last four columns clash with names that operators make
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, score double, host string, sampled boolean")


@pytest.fixture(scope="module")
def given(spark):
    common.prepare(spark)
    return spark.read.parquet(f"{D}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


# ------------------------------------------------------------ Simple-8b and token ids

@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_simple8b_round_trip(n):
    rng = np.random.default_rng(n)
    kinds = [
        np.zeros(n, np.uint64), rng.integers(0, 2, n).astype(np.uint64), rng.integers(0, 50257, n).astype(np.uint64),
        rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1),
        np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) - np.uint64(1),
        np.where(rng.random(n) < 0.02, rng.integers(0, 50257, n), 0).astype(np.uint64),
    ]
    for v in kinds:
        data = simple8b.pack(v)
        assert (simple8b.unpack(data) == v).all()
        if n > 600:
            assert (simple8b.unpack(data, 1, 3) == v[256:768]).all()
    assert len(simple8b.pack(np.zeros(25_600, np.uint64))) == 24 + 101 * 4 + 100 * 2 * 8  # two words a block: 240 zeros and the rest


def test_simple8b_refuses_other_bytes():
    with pytest.raises(ValueError):
        simple8b.unpack(b"nope" + b"\0" * 40)


def test_token_output(spark, docs, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from carelake.llm.encoding import tokenizer

    token_output.write_token_ids(docs, str(tmp_path / "ids"), path)
    got = sorted(map(tuple, token_output.read_token_ids(spark, str(tmp_path / "ids")).collect()), key=lambda r: r[1])
    want, at = [], 0
    for i, text in sorted(((t[0], t[1] or "") for t in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = [*tokenizer(path).encode(text, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    token_output.write_token_ids(docs.limit(0), str(tmp_path / "none"), path)
    assert token_output.read_token_ids(spark, str(tmp_path / "none")).count() == 0


def test_token_counts(docs):
    from carelake.llm.encoding import tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    got = Counter(map(tuple, token_count.token_counts(docs, path).collect()))
    sizes = [(t[0], len((t[1] or "").encode()), len(tokenizer(path).encode(t[1] or "", add_special_tokens=False).ids)) for t in TEXTS]
    assert got == Counter((*s, s[2] > 2048) for s in sizes)
    assert token_count.token_counts(docs.limit(0), path).count() == 0


# ------------------------------------------------------------ URL filter

URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.ORG/es/1", "http://sub.example.org/en/123?q#f", "http://example.org/en/2", "https://notexample.org/es/",
    "https://a.b.example.org/es/x", "https://x.com/fr/a", "https://x.com/de/a", "https://com/de/", "https://x.com/d", "https://example.org", "https://example.org?x=/es/",
    "https://user@example.org:80/es/", "a://b://example.org/es/", "http://" + "a." * 3000 + "example.org/es/", "http://org/", "http://.org/",
]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_filter(spark):
    common.prepare(spark)
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    want = sorted((i, *judged(u)) for i, u in enumerate(URLS * 2))
    found = url_filter.filter_urls(pages, RULES)
    assert found.columns == ["page_id", "url", "host", "_host", "path", "rule", "verdict"]
    assert sorted(map(tuple, found.select("page_id", "_host", "path", "rule", "verdict").collect())) == want
    rules = spark.createDataFrame(RULES, "host string, prefix string, verdict string")
    joined = url_filter.rules_by_join(pages.drop("host"), rules)
    assert sorted(map(tuple, joined.select("page_id", "host", "path", "rule", "verdict").collect())) == want
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}


def test_rules_without_an_order(spark):
    common.prepare(spark)
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("a.com", "/", "block"), ("a.com", "/", "allow"), ("b.com", "/", "allow")], "host string, prefix string, verdict string")
    assert sorted((r.page_id, r.verdict) for r in url_filter.rules_by_join(pages, rules).collect()) == [(1, "block"), (2, "allow")]
    numbered = rules.withColumn("n", F.when(F.col("verdict") == "allow", 1).otherwise(0))
    assert sorted((r.page_id, r.verdict) for r in url_filter.rules_by_join(pages, numbered).collect()) == [(1, "allow"), (2, "allow")]


def test_digest_array_survives_collisions(tmp_path):
    file = str(tmp_path / "list")
    weak = lambda x: len(x) % 3  # noqa: E731  nearly all digests collide
    rules = [(f"h{i}.net", f"/p{j}", "block" if j % 2 else "allow") for i in range(20) for j in range(5)]
    url_filter.write_digest_array(rules, file, weak)
    array = url_filter.DigestArray(file, weak)
    assert list(array.keys) == sorted(array.keys)
    found = array.match([b"h3.net", b"www.h7.net", b"h99.net", b""], [b"/p1x", b"/p4", b"/p1", b""])
    assert [array.string(k).decode() if k >= 0 else None for k in found] == ["h3.net/p1", "h7.net/p4", None, None]


# ------------------------------------------------------------ 304 revisits

def test_revisits(spark):
    h = {"ETag": '"1"', "Content-Length": "9", "Cache-Control": "a"}
    rows = [
        ("r0", "http://www.A.com:80/x?utm_source=q&b=2&a=1#f", 10, 200, h), ("r1", "https://a.com/x?a=1&b=2", 20, 200, {"ETag": '"2"', "Last-Modified": "m"}),
        ("r1b", "https://a.com/x?a=1&b=2", 20, 200, {"ETag": '"3"', "Last-Modified": "m"}), ("bad", "https://a.com/x?a=1&b=2", 21, 500, {"ETag": '"9"'}),
        ("v0", "https://a.com/x?b=2&a=1", 15, 304, {"etag": 'W/"1"', "content-length": "0", "cache-control": "b", "X": "y"}),
        ("v1", "https://a.com/x?b=2&a=1", 20, 304, {"ETag": '"1"'}),  # responses of the same time are not earlier
        ("v2", "https://a.com/x?b=2&a=1", 30, 304, {"ETag": '"2"'}), ("v3", "https://a.com/x?b=2&a=1", 30, 304, {"Last-Modified": "m"}),
        ("v4", "https://a.com/x?b=2&a=1", 30, 304, None), ("v5", "https://a.com/x?b=2&a=1", 5, 304, {"ETag": '"1"'}),
        ("v6", None, 5, 304, {"ETag": '"1"'}), ("v7", "https://a.com/x", None, 304, {"ETag": '"1"'}), ("v3", "https://a.com/x?b=2&a=1", 30, 304, {"Last-Modified": "m"}),
    ]
    hot = [(f"h{i}", "http://hot.org/", i, 304 if i % 7 else 200, {"ETag": f'"{i // 7}"'}) for i in range(3000)]
    records = spark.createDataFrame(rows + hot, "record_id string, url string, time long, status int, headers map<string,string>").withColumn("outcome", F.lit("own"))
    found = warc_revisit.resolve_revisits(records.repartition(5)).collect()
    got = defaultdict(list)
    for r in found:
        got[r.record_id].append((r.response_id, r.outcome, r.headers))
    assert got["v0"] == [("r0", "resolved", {"etag": 'W/"1"', "content-length": "9", "cache-control": "b", "x": "y"})]
    assert got["v1"] == [("r0", "resolved", {"etag": '"1"', "content-length": "9", "cache-control": "a"})]
    assert got["v2"] == [(None, "mismatch", None)] and [x[:2] for x in got["v3"]] == [("r1b", "resolved")] * 2
    assert [got[v][0][1] for v in ("v4", "v5", "v6", "v7")] == ["no_validator", "no_response", "no_url", "no_time"]
    assert all(got[f"h{i}"][0][:2] == (f"h{i // 7 * 7}", "resolved") for i in range(3000) if i % 7)
    assert warc_revisit.resolve_revisits(records.limit(0)).count() == 0


# ------------------------------------------------------------ benchmark decontamination

def brute_contamination(rows, items):
    import re

    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    wins = []
    for item, text in items:
        w = cut(text)
        n = min(10, len(w))
        wins += [(str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1)] if w else []
    out = []
    for i, text in rows:
        w = cut(text)
        hit, seen = set(), set()
        for item, win in wins:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    seen.add(item)
        out.append((i, len(w), len(hit), len(seen), ",".join(sorted(seen)), bool(hit)))
    return out


def test_contamination(spark):
    s = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = [(1, s), (2, "Lonely"), (3, "two words"), (10, s), (4, None), (5, "!!"), (6, "the the the the the the the the the the the the")]
    rows = [
        (1, "pre " + s + " post"), (2, "ALPHA-beta gamma,delta.epsilon zeta eta theta iota kappa"), (3, "beta gamma delta epsilon zeta eta theta iota kappa"), (4, "x lonely y lonely"),
        (5, "two, words two words"), (6, None), (7, ""), (None, "two words"), (8, "the " * 30), (9, s + " " + s), (9, "clean"), (9, s + " " + s), (11, "ÉCOLE 123 " * 400),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("contaminated", F.lit("own"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs, bench)
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in found.collect())
    assert got == Counter(brute_contamination(rows, items))
    assert [r[2] for r in decontaminate.contamination(docs, bench.limit(0)).select("doc_id", "n_words", "n_hit").collect()] == [0] * len(rows)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 9, 11]


def test_contamination_in_blocks(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/benchmark.parquet")
    whole = sorted(map(str, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 400)
    assert sorted(map(str, decontaminate.contamination(docs, bench).collect())) == whole


# ------------------------------------------------------------ SimHash

def plain_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, ids, distance=3):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                up[find(i)] = find(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)].append(x)
    return [min(least[find(i)]) if least[find(i)] else None for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "given"])
def test_near_duplicates(request, which):
    df = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    want = Counter(zip([i for i, _ in rows], (f"{x:016x}" for x in fps), classes(fps, [i for i, _ in rows]), strict=True))
    found = simhash.near_duplicates(df)
    assert Counter(map(tuple, found.select("doc_id", simhash.fingerprint_hex("fp"), "component_id").collect())) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    one = [r.doc_id for r in kept.collect()]
    assert len(one) == len(set(one)) and set(one) == {c for _, _, c in want}


def test_keep_one_keeps_unrelated_texts_of_one_id(spark):
    common.prepare(spark)
    rng = np.random.default_rng(3)
    text = [" ".join(bytes(rng.integers(97, 123, 5).astype(np.uint8)).decode() for _ in range(60)) for _ in range(6)]
    rows = [(1, text[0]), (1, text[1]), (None, text[2]), (None, text[3]), (None, text[3]), (None, text[4]), (7, text[4]), (3, text[5]), (2, text[5]), (2, text[5].upper())]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, text[0]), (1, text[1]), (None, text[2]), (None, text[3]), (7, text[4]), (2, text[5].upper())]
    assert Counter(map(tuple, got)) == Counter(want)


def test_near_duplicates_of_nothing(docs):
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())


@pytest.mark.parametrize("spread", [2, 40])
def test_shards_lose_no_link(spread):
    """A dense cloud of fingerprints, dealt to shards by a tree, against all pairs."""
    rng = np.random.default_rng(spread)
    out = {0, 2**64 - 1}
    for _ in range(1500):
        x = int(rng.integers(0, spread)) * 0x9E3779B97F4A7C15 % 2**64
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            x ^= 1 << int(b)
        out.add(x)
    f = np.array(sorted(out), np.uint64)
    a, b = [], []
    for h in (0, 1):
        half = simhash._half(f, h)
        tree = vptree.build(half[rng.permutation(len(f))[:300]], 40)
        row, leaf, home = vptree.route(tree, half, 1)
        assert home.sum() == len(f) and tree.leaves > 3
        for s in range(tree.leaves):
            k = row[leaf == s]
            x, y = vptree.links(f[k], half[k], home[leaf == s], 1, 3)
            a += k[x].tolist()
            b += k[y].tolist()
    assert all((int(f[x]) ^ int(f[y])).bit_count() <= 3 for x, y in zip(a, b, strict=True))
    got = vptree._roots(len(f), np.array(a), np.array(b), np.arange(len(f)))
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    p, q = np.nonzero(near)
    assert (got == vptree._roots(len(f), p, q, np.arange(len(f)))).all()
    assert len(a) < 6 * len(f)  # links, not pairs
    assert spread > 2 or near.sum() > 6 * len(f)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    found = simhash.components(spark.createDataFrame(chain + star + [(5, 5), (3, 2)], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}


# ------------------------------------------------------------ mixing

def test_mix(spark, docs):
    found = mixing.mix(docs)
    assert found.columns == [*docs.columns, "topic", "tokens", "weight", "probability", "_sampled"]
    rows = found.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.probability == 1 and r._sampled for r in rows if r.tokens == 0)
    assert len({(r.doc_id, r._sampled) for r in rows if r.doc_id == 8}) == 1
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rake_fits_all_three_marginals(spark):
    rng = np.random.default_rng(3)
    cells = [(f"s{s}", l, t, int(rng.integers(1, 1000)) * (400 if s == 0 else 1)) for s in range(30) for l in ("en", "fr", "") for t in ("x", "y") if rng.random() < 0.9]
    df = spark.createDataFrame([*cells, ("none", "en", "x", 0)], "source string, lang string, topic string, tokens long")
    found = mixing.rake(df, budget=0.5)
    rows = found.cells.collect()
    total = sum(c[3] for c in cells)
    assert found.gap < 1e-6
    for i, (name, alpha) in enumerate(mixing.ALPHA.items()):
        share, got = Counter(), Counter()
        for c in cells:
            share[c[i]] += c[3] / total
        norm = sum(v**alpha for v in share.values())
        for r in rows:
            got[r[i]] += r.tokens * r.weight
        assert all(math.isclose(got[k], v**alpha / norm, rel_tol=1e-6) for k, v in share.items()), name
    assert math.isclose(sum(r.tokens * min(1, found.scale * r.weight) for r in rows), 0.5 * total, rel_tol=1e-9)


# ------------------------------------------------------------ quality rules

def brute_statistics(text):
    text = text or ""
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(lines), len(set(w))


@pytest.mark.parametrize("which", ["docs", "given"])
def test_statistics(request, which):
    df = request.getfixturevalue(which)
    want = Counter((r.doc_id, *brute_statistics(r.text)) for r in df.collect())
    assert Counter(map(tuple, quality_rules.statistics(df).collect())) == want


def test_learned_list_is_native_and_accurate(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    found = quality_rules.judge(docs, labels.filter(train))
    test = found.join(labels.filter(~train), "doc_id").filter("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in test) >= 0.97 * len(test)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_learning_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = quality_rules.statistics(docs)
    assert quality_rules.learn(stats, none).rules == ()
    assert quality_rules.learn(stats, spark.createDataFrame([(1, 1), (2, None), (1, 0)], "doc_id long, quality int")).rules == ()
    assert quality_rules.judge(docs.limit(0), none).count() == 0
    kept = quality_rules.judge(docs, none)
    assert all(r.kept == (not r.base_failed) for r in kept.collect())


def test_list_grows_a_conjunction(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 100 + int(x), 500, int(y), 0, 0, 10, 90) for i, (x, y) in enumerate(zip(rng.integers(0, 900, 3000), rng.integers(0, 300, 3000), strict=True))]
    stats = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct long")
    labels = stats.select("doc_id", F.when((F.col("n_words") > 700) & (F.col("n_symbols") > F.col("n_words") * 0.2), 0).otherwise(1).alias("quality"))
    found = quality_rules.learn(stats, labels)
    assert found.rules and str(found).endswith("else keep")
    judged_rows = stats.withColumn("kept", found.kept()).join(labels, "doc_id")
    wrong = judged_rows.filter("kept != (quality = 1)").count()
    assert wrong < 0.04 * 3000


# ------------------------------------------------------------ toxicity

@pytest.mark.parametrize("kinds", [1, 4])
def test_block_max_neighbours_are_exact(kinds):
    """Against all similarities by definition; unlike groups of examples let blocks be skipped."""
    rng = np.random.default_rng(11)
    vectors = []
    for i in range(3000):
        own = rng.integers(0, 400, rng.integers(1, 30)) * kinds + i * kinds // 3000  # terms of the group
        t, n = np.unique(np.concatenate([own, rng.integers(0, 40, 6) * kinds + i * kinds // 3000]), return_counts=True)
        vectors.append((t, n.astype(np.uint16)))
    vectors += vectors[:200]  # repeats: ties
    n = len(vectors)
    starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
    terms, counts = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
    df = np.bincount(terms, minlength=1700)
    idf = np.log((2 + n) / (1 + df))
    index = BlockMaxIndex(starts, terms, counts, idf)
    dense = np.zeros((n, 1700))
    for i, (t, c) in enumerate(vectors):
        dense[i, t] = (1 + np.log(c.astype(float))) * idf[t]
    dense /= np.sqrt((dense**2).sum(axis=1))[:, None]
    asked = list(range(0, n, 41))
    found = list(index.nearest_of([(vectors[q][0], dense[q, vectors[q][0]]) for q in asked], 7, asked))
    for q, (at, sims, of, term, part) in zip(asked, found, strict=True):
        want = np.round(dense @ dense[q], 9)
        want[q] = -1
        best = [i for i in np.lexsort((np.arange(n), -want)) if want[i] > 0][:7]
        assert np.allclose(sims, want[best], atol=2e-9) and np.allclose(want[at], sims, atol=2e-9)
        assert np.allclose(np.bincount(of, part, len(at)), sims, atol=2e-9)  # the shared terms make the similarity
        assert all((dense[at[i], t] * dense[q, t] - p) < 1e-12 for i, t, p in zip(of, term, part, strict=True))
    assert index.met == len(asked) * index.blocks and (index.skipped > 0.3 * index.met if kinds > 1 else True)


def test_terms_of_many_examples_are_read_as_matrices():
    """No posting of a term that most examples of a segment hold is left to be read one by one; counts come back exactly, also the largest."""
    rng = np.random.default_rng(5)
    n = 2500  # two whole segments and a part of one
    vectors = []
    for i in range(n):
        t = np.unique(np.concatenate([np.flatnonzero(rng.random(30) < 0.6) + 30 * (i // 1300), rng.integers(60, 900, 12)]))
        vectors.append((t, rng.choice([1, 2, 3, 50, 65535], len(t)).astype(np.uint16)))
    starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
    terms, counts = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
    df = np.bincount(terms, minlength=900)
    idf = np.log((2 + n) / (1 + df))
    index = BlockMaxIndex(starts, terms, counts, idf)
    left = np.diff(index.first)
    assert left[:60].sum() < 0.05 * df[:60].sum() and (left[60:] == df[60:]).all()
    dense = np.zeros((n, 900))
    for i, (t, c) in enumerate(vectors):
        dense[i, t] = (1 + np.log(c.astype(float))) * idf[t]
    dense /= np.sqrt((dense**2).sum(axis=1))[:, None]
    asked = list(range(0, n, 61))
    queries = [(vectors[q][0], dense[q, vectors[q][0]]) for q in asked]
    for q, (t, _), (at, sims, parts) in zip(asked, queries, index.search(queries, 9, asked), strict=True):
        want = np.round(dense @ dense[q], 9)
        want[q] = -1
        best = np.lexsort((np.arange(n), -want))[:9]
        assert np.allclose(sims, want[best], atol=2e-9) and np.allclose(want[at], sims, atol=2e-9)
        assert np.allclose(parts, dense[at][:, t] * dense[q, t], atol=1e-12)


def test_a_text_scores_alike_in_any_company():
    """Texts are put in another order for the search: each gets its own votes, whatever is asked with it."""
    rng = np.random.default_rng(9)
    words = [b"w%03d" % i for i in range(300)]
    own = [np.unique(rng.integers(0, 300, 20)) for _ in range(150)]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in own])])
    term = np.concatenate(own).astype(np.int32)
    idf = np.log(152 / (1 + np.bincount(term, minlength=300)))
    scorer = toxicity.Scorer(np.array(words), idf, np.ones(300), list(range(150)), [i % 2 for i in range(150)], starts, term, np.ones(len(term), np.uint16), 0.5)
    texts = [b" ".join(words[t] for t in own[i % 150][i % 7 :]).upper() + b"-nothing" for i in range(1100)] + [b"", b"w000w000 W000x"]
    together = list(scorer.votes(texts))
    assert len(together) == len(texts)
    for i in [0, 1, 63, 64, 700, 1023, 1024, 1099, 1100, 1101]:
        share, at, sims = next(scorer.votes([texts[i]]))
        assert math.isclose(share, together[i][0], abs_tol=1e-12) and at.tolist() == together[i][1].tolist() and sims.tolist() == together[i][2].tolist()
    assert toxicity.term_counts(b"Abcdefgh ABCDEFxx, ab\xc3\xa9 a_b 12-34\x85") == {b"abcdef": 2, b"ab\xc3\xa9": 1, b"a": 1, b"b": 1, b"12": 1, b"34\x85": 1}


def test_toxicity(spark, docs):
    d = "/root/testdata/sf0.1"
    given, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.fit(given, labels)
    found, names = toxicity.score(given, scorer)
    assert found.columns[: len(given.columns)] == given.columns
    held = found.join(labels, "doc_id").filter(common.fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT).collect()
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.predicted for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert caught > 0.85 and wrong < 0.05
    assert all(e.similarity > 0 for r in held for e in r.evidence)
    # clashing names, nulls, repeats, empty tables
    own, names = toxicity.score(docs, scorer)
    assert own.columns == [*docs.columns, "_score", "predicted", "evidence"] and own.count() == len(TEXTS)
    assert {r._score for r in own.collect() if r.doc_id in (3, 4, 5)} == {scorer.calibrated(scorer.prior)}
    assert toxicity.score(docs.limit(0), scorer)[0].count() == 0
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == len(TEXTS)


@pytest.mark.parametrize("labelled", [[], [(1, None)], [(-5, 1)], [(1, 1), (6, 1), (7, 1), (8, 1)]])
def test_no_document_is_toxic_without_evidence(spark, docs, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    found, names = toxicity.score(docs, toxicity.fit(docs, labels))
    assert {(r[names["score"]], r[names["predicted"]]) for r in found.collect()} == {(0.0, 0)}
    assert toxicity.drop_toxic(docs, labels).count() == len(TEXTS)


def test_toxicity_votes_by_plain_tf_idf_neighbours(spark):
    """Scores, neighbours and votes against a version that shares no code: dense vectors over every term of the examples."""
    common.prepare(spark)
    rng = np.random.default_rng(7)
    some = [bytes(rng.integers(97, 123, rng.integers(3, 9)).astype(np.uint8)).decode() for _ in range(90)]
    texts = [" ".join(rng.choice(some, 30)) + (" vileword" if i % 3 == 0 else "") + (f" q{i}zz" if i % 5 == 0 else "") for i in range(240)]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    scorer = toxicity.fit(given, labels)
    train = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 != 2]
    count = {i: Counter(w[:6] for w in t.encode().split()) for i, t in enumerate(texts)}
    terms = sorted({x for i in train for x in count[i]})
    assert len(scorer.idf) == len(terms) and sorted(scorer.ids) == train
    n, y = len(train), np.array([i % 3 == 0 for i in train], float)
    has = np.array([[x in count[i] for x in terms] for i in train], float)
    df, pos = has.sum(axis=0), has[y == 1].sum(axis=0)
    idf = np.log((2 + n) / (1 + df))
    full = np.array([[(1 + math.log(count[i][x])) * v if count[i][x] else 0.0 for x, v in zip(terms, idf, strict=True)] for i in range(240)])
    full /= np.sqrt((full * full).sum(axis=1))[:, None]
    n1, n0, neg = y.sum(), n - y.sum(), df - pos
    z = abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(df / n * (1 - df / n), 0.25 / n) * (1 / n1 + 1 / n0))
    lift = abs(np.log(((pos + 0.5) / (n1 + 1)) / ((neg + 0.5) / (n0 + 1))))
    telling = 0.02 + np.minimum(z / 10, 1) * np.minimum(lift, 3)
    prior = (n1 + 0.5) / (n + 1)
    order = [train.index(i) for i in scorer.ids]  # equal similarities: the index's order

    def share(q, without=None):
        sims = np.round(full[train] @ full[q], 9)
        best = [j for j in sorted(order, key=lambda j: (-sims[j], order.index(j))) if sims[j] > 0 and train[j] != without][:64]
        votes = (full[train][best] * full[q] * telling).sum(axis=1)
        return (votes @ y[best] + 1e-3 * prior) / (votes.sum() + 1e-3), {train[j]: sims[j] for j in best}

    bins = [min(19, int(share(i, i)[0] * 20)) for i in train]
    positive, total = (np.bincount(bins, v, 20) for v in (y, np.ones(n)))
    middle = (np.arange(20) + 0.5) / 20
    levels = toxicity.monotone((positive + 2 * middle).tolist(), (total + 2.0).tolist())
    assert np.allclose(scorer.levels, levels, atol=1e-6)
    for r in toxicity.score(given, scorer)[0].collect():
        want, near = share(r.doc_id)
        assert math.isclose(r.score, np.interp(want, np.linspace(0, 1, 20), levels), abs_tol=1e-4)
        assert len(r.evidence) == toxicity.EVIDENCE and all(math.isclose(near[int(e.id)], e.similarity, abs_tol=2e-9) for e in r.evidence)
    # a term of one example is enough for evidence, and one telling word does not make a long text equal to a short one
    lone = next(i for i in train if i % 5 == 0)
    asked = spark.createDataFrame([(0, f"q{lone}zz"), (1, "vileword " + " ".join(some))], "doc_id long, text string")
    lonely, long = sorted(toxicity.score(asked, scorer)[0].collect())
    assert lonely.evidence[0].id == str(lone) and max(e.similarity for e in long.evidence) < 0.99


def test_a_process_holds_one_index():
    def scorer(n):
        starts, term = np.arange(n + 1), np.zeros(n, np.int32)
        return toxicity.Scorer(np.array([b"a"]), np.ones(1), np.ones(1), list(range(n)), [i % 2 for i in range(n)], starts, term, np.ones(n, np.uint16), 0.5)

    one, two = scorer(4), scorer(6)
    first = list(one.votes([b"a", b""]))
    list(two.votes([b"a"]))
    assert one.index is None and two.index is not None
    again = list(one.votes([b"a", b""]))  # made anew where it is needed again
    assert two.index is None and [v[0] for v in again] == [v[0] for v in first]


def test_a_process_lets_an_index_go():
    """With the scorer that a broadcast brought, and when the process turns to other work that holds much."""
    def scorer():
        return toxicity.Scorer(np.array([b"a"]), np.ones(1), np.ones(1), [0, 1], [0, 1], np.arange(3), np.zeros(2, np.int32), np.ones(2, np.uint16), 0.5)

    one = scorer()
    first = list(one.votes([b"a"]))
    index = weakref.ref(one.index)
    del one
    assert index() is None
    two, cache = scorer(), encoding.PieceCache(lambda batch: [len(x) for x in batch])
    list(two.votes([b"a"]))
    assert cache.lookup({b"abc"}) == {b"abc": 3}
    assert two.index is None and two.vectors.number is None and cache.lookup({b"d"}) == {b"abc": 3, b"d": 1}
    assert [v[0] for v in two.votes([b"a"])] == [v[0] for v in first] and not cache.young and not cache.old
    assert cache.lookup({b"abc"}) == {b"abc": 3}


def test_calibration_is_monotone():
    got = toxicity.monotone([0, 3, 1, 5, 5], [5, 5, 5, 5, 5])
    assert (np.diff(got) >= 0).all() and np.allclose(got, [0, 0.4, 0.4, 1, 1])


# ------------------------------------------------------------ lattice

def all_paths(word, p):
    """Sum over every segmentation of ``word`` into pieces, by plain recursion."""
    if not word:
        return 1.0
    return sum(p[word[:k]] * all_paths(word[k:], p) for k in range(1, len(word) + 1) if word[:k] in p)


def test_lattice_sums_all_segmentations(monkeypatch):
    from carelake.llm import lattice as module

    pieces = sorted([b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"abb", b"c", END])
    rng = np.random.default_rng(2)
    mass = rng.random(len(pieces))
    lat = PieceLattice(pieces, np.log(mass / mass.sum()))
    p = dict(zip(pieces, np.exp(lat.log_p), strict=True))
    found = [b"abba", b"a", b"b", b"abbabbac", b"", b"d", b"cab" * 4]
    got, _ = lat.run(found)
    for w, s in zip(found, got, strict=True):
        want = all_paths(b" " + w, p)
        assert math.isclose(math.exp(s), want, rel_tol=1e-9) if want else s == -np.inf
    # expected counts: the derivative of the log sum
    weights = np.array([1.0, 2, 1, 3, 1, 0, 1])
    _, counts = lat.run(found[:5] + found[6:], np.array([1.0, 2, 1, 3, 1, 1]))
    step = 1e-6
    for i in range(len(pieces)):
        moved = lat.log_p.copy()
        moved[i] += step
        more, _ = PieceLattice(pieces, moved).run(found[:5] + found[6:])
        less, _ = lat.run(found[:5] + found[6:])
        assert math.isclose(((more - less) @ np.delete(weights, 5)) / step, counts[i], rel_tol=1e-3, abs_tol=1e-4)
    monkeypatch.setattr(module, "LONG", 3)  # the walk for long words gives the same
    again, counts2 = lat.run(found[:5] + found[6:], np.array([1.0, 2, 1, 3, 1, 1]))
    assert np.allclose(again, np.delete(got, 5)) and np.allclose(counts, counts2)


def test_long_words_stay_finite():
    lat = PieceLattice(*load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    got, counts = lat.run([b"ab" * 20_000, bytes(range(128, 256)) * 4], np.ones(2))
    assert np.isfinite(got).all() and got[0] < -10_000 and np.isfinite(counts).all()


@pytest.mark.parametrize("which", ["docs", "given"])
def test_lm_scores(request, which, monkeypatch):
    df = request.getfixturevalue(which)
    monkeypatch.setattr(lm_score, "COMMON_WORDS", 40)
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(r.doc_id, r.text, r.lang or "") for r in df.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count, by_class, n_texts = Counter(), defaultdict(Counter), Counter()
    for i, t, c in rows:
        if not held(i):
            count.update(words(t))
            by_class[c].update(words(t))
            n_texts[c] += 1
    ends = sum(n_texts.values())
    n, v = count.total() + ends, len(count) + 1

    def discount(c):
        n1, n2 = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
        return n1 / (n1 + 2 * n2) if n1 else 0.5

    pieces, prior = load_pieces(model_file)
    start = np.array([p[:1] == b" " for p in pieces])
    lat = PieceLattice(pieces, lm_score._normed(pieces, np.exp(prior)))
    _, c = lat.run(list(count), np.ones(len(count)))
    c[pieces.index(END)] += len(count)
    p0 = np.exp(prior)
    lat = PieceLattice(pieces, lm_score._normed(pieces, np.where(start, p0 / p0[start].sum(), p0 / p0[~start].sum()) * lm_score.PRIOR_WEIGHT + c))
    vocabulary = sorted({w for _, t, _ in rows for w in words(t)})
    sub = dict(zip(vocabulary, lat.run(vocabulary)[0] + lat.end_log_p, strict=True))
    spread = Counter(w for x in by_class.values() for w in x)
    m_all = spread.total()
    d, ds = discount(spread), {k: discount(x) for k, x in by_class.items()}
    sizes = {k: x.total() + n_texts[k] for k, x in by_class.items()}

    free, own_free = d * len(count) + 1, {k: ds[k] * len(by_class[k]) + 1 for k in n_texts}

    def log10_p(w, k):
        whole = (max(spread[w] - d, 0) + free * math.exp(sub[w])) / (m_all + 2)
        p = (max(by_class[k][w] - ds[k], 0) + own_free[k] * whole) / (sizes[k] + 1)
        return math.log10(p) if p > 1e-290 else math.log10(free / (m_all + 2) * own_free[k] / (sizes[k] + 1)) + sub[w] / math.log(10)

    def end(k):
        return math.log10((n_texts[k] + own_free[k] / (m_all + 2)) / (sizes[k] + 1))

    want = []
    for i, t, _ in rows:
        w = words(t)
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        per = [sum(log10_p(x, k) for x in w) + end(k) + math.log10(m / ends) for k, m in n_texts.items()]
        top = max(per)
        want.append((-1 if i is None else i, held(i), len(w) + 1, sum(count[x] > 0 for x in w) + 1, n, base, top + math.log10(sum(10 ** (x - top) for x in per))))
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in lm_score.lm_scores(df, model_file, rounds=1).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-8), (g, w)


def test_lm_scores_without_rows(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert lm_score.lm_scores(docs.limit(0), path).count() == 0
