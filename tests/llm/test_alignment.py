"""Alignment against a plain version: token ends as sets, links by comparing all pairs of a document."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from carelake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["the", "Ünï", "naïve", "don't", " ", "  ", "\n", "\n\n", "\t", ",", "...", "<|endoftext|>", "</s>", "<0x0A>", "42", "漢字", "🙂", " ", "　", "▁", "\x00", "é", "́", "zq", "tion", "\r", "\x1c", "##"]


def _tables():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    of = {}
    own = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    for k, b in enumerate(own + [b for b in range(256) if b not in own]):
        of[chr(b) if k < len(own) else chr(256 + k - len(own))] = b
    return t, sp, of


def plain(texts):
    """The contract's columns for each text, by definition."""
    t, sp, of = _tables()
    docs, held = [], Counter()
    for text in texts:
        row = {"a": [], "b": [], "groups": "", "links": []}
        if text:
            raw = (" " + text).encode()
            a = [(e.id, bytes(of[c] for c in t.id_to_token(e.id))) for e in [type("E", (), {"id": i}) for i in t.encode(" " + text, add_special_tokens=False).ids]]
            b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
            if b"".join(x for _, x in a) == raw and b"".join(x for _, x in b) == raw:
                spans = []
                for side in (a, b):
                    at, s = 0, []
                    for i, x in side:
                        s.append((i, at, at + len(x)))
                        at += len(x)
                    spans.append(s)
                shared = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
                groups, low = [], 0
                for cut in shared:
                    groups.append("|".join(",".join(str(i) for i, s, e in side if s >= low and e <= cut) for side in spans))
                    low = cut
                row = {"a": spans[0], "b": spans[1], "groups": ";".join(groups), "n": len(groups)}
                row["links"] = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
                held.update(set(row["links"]))
        docs.append(row)
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [
        (len(d["a"]), len(d["b"]), d.get("n", 0), len(d["links"]), sum(held[x] == best[x[0]] for x in d["links"]), sum(held[x] for x in d["links"]), hashlib.sha256(d["groups"].encode()).hexdigest() if d["a"] else "")
        for d in docs
    ]


def texts(n, seed=3):
    rng = random.Random(seed)
    return [None, "", " ", "  ", "\n", "a", "▁", "the " * 400] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("slices", [1, 3])
def test_alignment_matches_the_plain_version(spark, monkeypatch, slices):
    own = texts(300)
    own += own[20:40]  # repeated rows
    df = spark.createDataFrame([(i if i % 3 else None, x, "clash") for i, x in enumerate(own)], "doc_id long, text string, pairs string").repartition(5)
    if slices > 1:
        monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 150)
    got = alignment.alignments(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter((i if i % 3 else None, *r) for i, r in enumerate(plain(own)))
    assert Counter(map(tuple, got.collect())) == want


def test_long_text_in_stretches_is_the_same(monkeypatch):
    text = " ".join(texts(120, seed=9)[8:]).replace("▁", "_")
    whole = alignment.align([text.encode()], A, B)[0]
    monkeypatch.setattr(alignment, "STRETCH_BYTES", 200)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 700)
    cut = alignment.align([text.encode()], A, B)[0]
    assert len(cut.codes) > 5 and whole.n_groups > 100
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert getattr(whole, c) == getattr(cut, c)
    assert whole.digest.hexdigest() == cut.digest.hexdigest()
    for x, y in zip(whole.pairs(), cut.pairs(), strict=True):
        assert x.tolist() == y.tolist()


def test_shared_cuts_are_the_common_ends():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 400):
        for p in (0.02, 0.5, 0.95):
            a = np.flatnonzero(rng.random(n) < p).astype(np.int64)
            b = np.flatnonzero(rng.random(n) < 0.5).astype(np.int64)
            i, j = alignment.shared_cuts(a, b)
            assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()
    even, odd = np.arange(0, 4000, 2), np.arange(1, 4001, 2)  # no shared end at all
    assert len(alignment.shared_cuts(even, odd)[0]) == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignments(df, A, B).collect() == []
