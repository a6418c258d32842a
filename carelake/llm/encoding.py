"""Exact piecewise encoding with a public tokenizer of the ``tokenizers`` library.

A text may be cut before a run of white space that follows a character that is no white space, and between
a letter and a mark: no pre-token, normalisation step or special token of the two supported kinds reaches
over such a place (byte-level: a run of white space belongs to what comes after it; word-level: white
space is dropped).  The pieces of such cuts repeat from text to text, so each distinct piece is encoded once per batch
and kept in a bounded cache of the worker process.
"""

from __future__ import annotations

import functools
import os
import re
import sys
import weakref
from array import array
from collections.abc import Callable, Iterable, Iterator

from .common import hold_alone

GENERATION = 350_000  # pieces kept per worker process in each of two generations
CACHED_BYTES = 256  # a longer piece is encoded, but not kept
BATCH_BYTES = 1 << 18  # bytes of text handed to the encoder at once
SLICE_BYTES = 1 << 20  # bytes of a text cut at once

# Letters that every definition takes as such (ASCII and Latin-1), and ASCII marks without the apostrophe, which
# may join the letters after it, and without "<", which may begin a special token.
_MORE = rb"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][A-Za-z]*+)"
_LETTERS = rb"(?:[A-Za-z]++" + _MORE + rb"*+|" + _MORE + rb"++)"
_MARKS = rb"[!-&(-/:;=-@\[-`{-~]"
_PIECE = re.compile(
    rb"[\t-\r ]*+" + _LETTERS + rb"(?=[\t-\r -&(-/:;=-@\[-`{-~]|\Z)"  # a word before white space or a mark
    rb"|[\t-\r ]*+" + _MARKS + rb"++(?=[\t-\r A-Za-z]|\Z)"  # marks before white space or a letter
    rb"|[\t-\r ]*[^\t-\r ]+|[\t-\r ]+"  # anything else up to white space
)
# A place that is safe in any text: ASCII white space after an ASCII character that is printed.
_SAFE = re.compile(rb"(?<=[!-~])(?=[\t-\r ])")
# Other characters that one or another definition takes as white space: a cut beside them may not be safe.
_MAYBE_ODD = re.compile(rb"[\x1c-\x1f\xc2\xe1\xe2\xe3\xef]")
_ODD = [bytes([c]) for c in (0x1C, 0x1D, 0x1E, 0x1F)] + [
    c.encode() for c in "\u0085\u00a0\u1680\u180e\u2028\u2029\u202f\u205f\u2060\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x2010))) + "".join(map(chr, range(0x202A, 0x202F)))
]

@functools.lru_cache(maxsize=4)
def tokenizer(path: str, plain: bool = False):
    """The tokenizer of a file, loaded once per worker process, without its own threads, padding or truncation.

    With ``plain``, the strings of special tokens inside a text are ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    if plain:
        t.encode_special_tokens = True
    return t


def is_odd(text: bytes) -> bool:
    return _MAYBE_ODD.search(text) is not None and any(x in text for x in _ODD)


def slices(text: bytes) -> Iterator[bytes]:
    """The text cut at safe places into parts of about ``SLICE_BYTES``."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        m = _SAFE.search(text, start + SLICE_BYTES)
        if m is None:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def pieces(text: bytes, keep_white: bool) -> Iterator[list[bytes]]:
    """The safe pieces of a text, slice by slice; with ``keep_white``, white space stays before its piece.

    Around odd characters a slice is cut at safe places alone.
    """
    for part in slices(text):
        if is_odd(part):
            found = [p for x in _SAFE.split(part) for p in ([x] if is_odd(x) else _PIECE.findall(x))]
        else:
            found = _PIECE.findall(part)
        yield found if keep_white else [x.strip() for x in found]


def balanced(items: Iterable[bytes], target: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The items in batches of about ``target`` bytes each."""
    batch, size = [], 0
    for x in items:
        batch.append(x)
        size += len(x) + 16
        if size >= target:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


_HELD: weakref.WeakSet[PieceCache] = weakref.WeakSet()  # caches of this process


def _drop_pieces() -> None:
    for cache in _HELD:
        cache.young, cache.old = {}, {}


class PieceCache:
    """What ``encode`` makes of each piece, for the texts of one batch after another.

    Two generations bound it: when the younger one is full it becomes the older one, and what is looked up
    in the older one moves back to the younger, so pieces in use stay.
    """

    def __init__(self, encode: Callable[[list[bytes]], Iterable]) -> None:
        self.encode, self.young, self.old = encode, {}, {}

    def lookup(self, wanted: set[bytes]) -> dict[bytes, object]:
        """Values of the wanted distinct pieces, the unknown ones encoded in batches balanced by bytes."""
        hold_alone("pieces", _drop_pieces)
        _HELD.add(self)
        if len(self.young) > GENERATION:
            self.young, self.old = {}, self.young
        young, old, new, extra = self.young, self.old, [], {}
        for x in wanted.difference(young):
            v = old.get(x)
            if v is None:
                new.append(x)
            else:
                young[x] = v
        for batch in balanced(new):
            for x, v in zip(batch, self.encode(batch), strict=True):
                (young if len(x) <= CACHED_BYTES else extra)[x] = v
        return young if not extra else {**young, **extra}


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


# One pre-token of a byte-level tokenizer: letters, or marks, after at most one blank.
_SINGLE = re.compile(rb" ?(?:" + _LETTERS + rb"|" + _MARKS + rb"++)\Z")


def byte_level() -> dict[int, str]:
    """Character of each byte in a byte-level vocabulary: printed Latin-1 characters stand for themselves, the other
    bytes in ascending order for the characters from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class ByteEncoder:
    """Ids of pieces.  A piece that is one pre-token goes to the tokenizer's model at once, any other through all its steps."""

    def __init__(self, path: str, plain: bool) -> None:
        self.tokenizer, self.table = tokenizer(path, plain), byte_level()
        probes = [b" the", b"Word", b" \xc3\xbcber", b"na\xc3\xafve", b" ...", b"###", b" qzx", b"ing", b" )", b"$$$", b" Zeitung", b"%"]
        self.direct = all(self._model(x) == self.tokenizer.encode(x.decode(), add_special_tokens=False).ids for x in probes)

    def _model(self, piece: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(self.table))]

    def __call__(self, batch: list[bytes]) -> list[bytes]:
        tokenize, table, single = self.tokenizer.model.tokenize, self.table, _SINGLE.match
        out = [id_bytes([t.id for t in tokenize(x.decode("latin-1").translate(table))]) if self.direct and single(x) else None for x in batch]
        rest = [k for k, v in enumerate(out) if v is None]
        found = self.tokenizer.encode_batch_fast([batch[k].decode("utf-8", "replace") for k in rest], add_special_tokens=False)
        for k, e in zip(rest, found, strict=True):
            out[k] = id_bytes(e.ids)
        return out


@functools.lru_cache(maxsize=4)
def id_cache(path: str, plain: bool = False) -> PieceCache:
    return PieceCache(ByteEncoder(path, plain))


@functools.lru_cache(maxsize=4)
def length_cache(path: str) -> PieceCache:
    t = tokenizer(path)
    return PieceCache(lambda batch: [len(e) for e in t.encode_batch_fast([x.decode("utf-8", "replace") for x in batch], add_special_tokens=False)])


def encode_lengths(texts: list[bytes], path: str) -> list[int]:
    """Number of ids of each text."""
    cache, out = length_cache(path), []
    for group in _grouped(texts):
        cut = [list(pieces(x, False)) for x in group]
        known = cache.lookup(set().union(*[part for parts in cut for part in parts])).__getitem__
        out += [sum(sum(map(known, part)) for part in parts) for parts in cut]
    return out


def encode_ids(texts: list[bytes], path: str, plain: bool = False) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    cache, out = id_cache(path, plain), []
    for group in _grouped(texts):
        cut = [list(pieces(x, True)) for x in group]
        known = cache.lookup(set().union(*[part for parts in cut for part in parts])).__getitem__
        out += [b"".join([b"".join(map(known, part)) for part in parts]) for parts in cut]
    return out


def _grouped(texts: list[bytes], target: int = 4 << 20) -> Iterator[list[bytes]]:
    return balanced(texts, target)
