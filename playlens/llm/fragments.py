"""Cutting text into fragments that a byte-level BPE tokenizer encodes
independently, and a per-worker cache of their encodings.

A cut between two bytes is *certain* when no token of the vocabulary can span
it. Two rules give certain cuts without running the tokenizer:

* the byte pair occurs inside no vocabulary token (the table of
  ``token_pairs``), so no merge can join the two sides;
* the pre-tokenizer always ends a piece there (a letter or digit followed by
  white space or by ``.`` / ``,``; any non-space followed by white space; a
  line feed followed by a non-space).

The fast path cuts before space, line feed, ``.`` and ``,`` with one
``replace`` chain and one ``split`` over the bytes of a text. It is taken only
when every such cut is certain under the second rule, which is checked on the
byte classes of the text with plain substring searches; other texts take the
caller's whole-text path. Cuts depend on the text alone, so results never
depend on batches, partitions or the cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

from playlens.llm.workercache import CACHE_BYTES, BoundedCache

#: Byte classes: W letter or digit, S white space, P full stop or comma,
#: O other ASCII, X anything whose class needs decoding (and the marker byte).
_WORD, _SPACE, _STOP, _OTHER, _UNKNOWN = b"WSPOX"


def _classes() -> bytes:
    out = bytearray([_OTHER]) * 128 + bytearray([_UNKNOWN]) * 128
    for b in range(128):
        if chr(b).isalnum():
            out[b] = _WORD
    for b in (9, 10, 11, 12, 13, 32):
        out[b] = _SPACE
    for b in b".,":
        out[b] = _STOP
    out[0] = _UNKNOWN
    # Two-byte letters U+00C0..U+017F: lead bytes C3..C5 and continuations;
    # the two signs among them are searched for by themselves.
    out[0x80:0xC0] = bytes([_WORD]) * 0x40
    out[0xC3] = out[0xC4] = out[0xC5] = _WORD
    return bytes(out)


CLASS_OF = _classes()
#: U+00D7 and U+00F7, the non-letters of U+00C0..U+017F (fixed values).
SIGNS = (b"\xc3\x97", b"\xc3\xb7")
MARK = b"\0"
_LINE = 10
_CUT_BEFORE = np.zeros(256, bool)
_CUT_BEFORE[list(b" \n.,")] = True
#: First bytes of a character other than an apostrophe.
_MAY_BEGIN = np.array([b & 0xC0 != 0x80 and b != 0x27 for b in range(256)])
_IS_WORD, _IS_OTHER = (np.frombuffer(CLASS_OF, np.uint8) == kind for kind in (_WORD, _OTHER))

#: One pre-token for sure: an optional space and then letters, digits or signs
#: (no apostrophe), or one line feed; and a run of such pre-tokens.
SINGLE_WORD = re.compile(
    rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4\xc5][\x80-\xbf])+|[0-9]+|[!-&(-/:-@\[-`{-~]+)|\n"
)
SEVERAL_WORDS = re.compile(rb"(?:" + SINGLE_WORD.pattern + rb")+")
#: The single words among fragments joined by ``MARK``.
_ALONE = re.compile(rb"(?<![^\0])(?:" + SINGLE_WORD.pattern + rb")(?![^\0])")


def splits_plainly(text: bytes, special: tuple[bytes, ...] = ()) -> bool:
    """Whether every cut of ``split`` is certain for this text."""
    kinds = text.translate(CLASS_OF)
    if b"X" in kinds or b"SS" in kinds or b"SP" in kinds or b"PP" in kinds or b"OP" in kinds:
        return False
    if b"\xc3" in text and any(s in text for s in SIGNS):
        return False
    return not any(s in text for s in special)


def split(text: bytes) -> list[bytes]:
    """The fragments of a text for which ``splits_plainly`` holds, in order;
    their concatenation is the text."""
    return (
        text.replace(b" ", b"\0 ").replace(b"\n", b"\0\n").replace(b".", b"\0.").replace(b",", b"\0,").split(MARK)
    )


def byte_pairs(tokens: Iterable[bytes]) -> np.ndarray:
    """Whether a byte (upper half of the position) is followed by another one
    (lower half) inside some token."""
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        raw = np.frombuffer(token, np.uint8)
        inside[raw[:-1], raw[1:]] = True
    return inside.ravel()


def fragment_array(texts: list[bytes], inside: np.ndarray, other: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The fragments of all texts, for which ``splits_plainly`` holds, and how
    many of them lie before each text and at the end. Beside the cuts of
    ``split``, line feeds are cut from what follows, words from the signs behind
    them (the pre-tokenizer ends a run of letters or digits there), and characters whose bytes are
    neighbours ``inside`` no token are cut, but not before an apostrophe, which
    may be read as a contraction then. Cuts at pairs inside a token of an
    ``other`` vocabulary are left out."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    before, behind = raw[:-1], raw[1:]
    pair = before.astype(np.uint16) << 8 | behind
    inner = ~inside[pair] & _MAY_BEGIN[behind]
    inner |= _CUT_BEFORE[behind] | (before == _LINE) | _IS_WORD[before] & _IS_OTHER[behind]
    if other is not None:
        inner &= ~other[pair]
    cut = np.concatenate([[True], inner, [True]]) if len(raw) else np.ones(1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(cut)
    buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers), np.searchsorted(starts, bounds)


def encode_fragments(
    texts: list[bytes],
    cache: BoundedCache,
    together: Callable[[list[bytes]], list[bytes]],
    inside: np.ndarray,
    other: np.ndarray | None = None,
) -> list[bytes]:
    """The joined values of every text's fragments. Each distinct fragment of
    the texts is looked up once, and ``together`` encodes those that are new."""
    fragments, bounds = fragment_array(texts, inside, other)
    coded = fragments.dictionary_encode()
    values = pa.array(cache.values_of(coded.dictionary.to_pylist(), together), pa.large_binary()).take(coded.indices)
    if not len(values):
        return [b""] * len(texts)
    _, ends, joined = values.buffers()
    at = np.frombuffer(ends, np.int64)[values.offset :][bounds].tolist()
    joined = memoryview(joined) if joined is not None else memoryview(b"")
    return [bytes(joined[i:j]) for i, j in zip(at, at[1:])]


def single_words(fragments: list[bytes]) -> list[bytes]:
    """Those of the fragments (none of which holds the marker byte) that are one pre-token for sure, in order."""
    return _ALONE.findall(MARK.join(fragments))


class FragmentCache(BoundedCache):
    """fragment -> its ids as little-endian uint32 bytes, in a bounded cache."""

    def __init__(self, encode: Callable[[bytes], bytes], limit: int = CACHE_BYTES):
        super().__init__(limit)
        self.encode = encode

    def __missing__(self, fragment: bytes) -> bytes:
        ids = self.encode(fragment) if fragment else b""
        self.keep(fragment, ids, len(ids))
        return ids
