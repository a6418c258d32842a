"""Piecewise encoding against the library's encoding of whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest

from carelake.llm import encoding

PARTS = [
    "the", "Erthat", "idiot", "über", "Ñandú", "œuvre", "naïve", "don't", "it's", "we'll", "x'S", "'", "''", "can't've",
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　", "​", "﻿", "᠎",
    ",", ".", "...", "!?", "|", "%%%", "$$$", "***", "<", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "|>", "<|", "(", ")", "_", "`", "^",
    "0", "42", "3.14", "1,000", "²", "½", "٣", "日本語", "中文", "é", "́", " ́a", "ß", "ẞ", "ΑΣ", "İ", "🙂", "👩‍👩‍👧", "×", "÷", "µ", "ª", "\x00", "\x7f",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_texts_encode_as_in_whole(name):
    path, rng = public_tokenizers.path(name), random.Random(7)
    texts = ["", " ", "\n ", "a" * 300 + "b"] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    raw = [t.encode() for t in texts]
    t = encoding.tokenizer(path)
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert encoding.encode_lengths(raw, path) == [len(w) for w in want] or name.startswith("byte")
    if name.startswith("byte"):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoding.encode_ids(raw, path)]
        assert [x for x, w in zip(texts, want, strict=True) if got[texts.index(x)] != w] == []
    else:
        got = encoding.encode_lengths(raw, path)
        assert [x for x, n, w in zip(texts, got, want, strict=True) if n != len(w)] == []


def test_long_texts_are_cut_only_before_white_space(monkeypatch):
    monkeypatch.setattr(encoding, "SLICE_BYTES", 50)
    text = ("word  and \n more" * 40 + "x" * 200 + " end ").encode()
    parts = list(encoding.slices(text))
    assert b"".join(parts) == text and len(parts) > 5
    assert all(p[:1].isspace() and not q[-1:].isspace() for q, p in zip(parts, parts[1:], strict=False))
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = encoding.tokenizer(path).encode(text.decode(), add_special_tokens=False).ids
    assert np.frombuffer(encoding.encode_ids([text], path)[0], "<u4").tolist() == whole


def test_cache_keeps_pieces_in_use(monkeypatch):
    monkeypatch.setattr(encoding, "GENERATION", 10)
    cache = encoding.length_cache.__wrapped__(public_tokenizers.path("word_bpe_49k.json"))
    for i in range(50):
        found = cache.lookup({b"the", f"w{i}".encode(), b"y" * 400})
        assert found[b"the"] == 1 and found[b"y" * 400] > 1
    assert b"the" in cache.young and len(cache.young) + len(cache.old) < 40


def test_batches_are_balanced_by_bytes():
    items = [b"x" * n for n in (5, 100, 3000, 1, 40, 40, 2000)]
    got = list(encoding.balanced(items, 500))
    assert [x for b in got for x in b] == items and all(b for b in got)
    assert max(sum(map(len, b[:-1])) for b in got) < 500
