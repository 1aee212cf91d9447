"""Token ids by the ``tokenizers`` library, one worker-wide encoder per file.

``encode(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``
for a byte-level BPE file with the usual word pattern. A text whose cuts are
certain (``fragments``) is encoded fragment by fragment through the library's
own model, each distinct fragment once while the worker's bounded cache holds
it, and the new fragments of a slice of texts together; any other text goes
through the library whole.
"""

from __future__ import annotations

import json
import os
import struct
from functools import lru_cache
from itertools import compress

import numpy as np

from playlens.llm.fragments import MARK, SEVERAL_WORDS, SINGLE_WORD, byte_pairs, encode_fragments, single_words, splits_plainly
from playlens.llm.workercache import BoundedCache, hold

#: Bytes and rows of the slices of texts whose new fragments are encoded together.
ENCODED_BYTES, ENCODED_ROWS = 2 << 20, 8192
#: Words that go through the library in one call.
WORDS = 1024


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others take the code points from
    256 upwards in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordModel:
    """Ids of many single words in a call: the model of a byte-level BPE
    tokenizer behind a pre-tokenizer that cuts at a sign between the words."""

    def __init__(self, model):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model, self.tokenizer = model, Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(MARK.decode())
        symbols = byte_symbols()
        self.symbols = np.array([ord(symbols[b]) if b else 0 for b in range(256)], "<u4")  # no word holds the sign
        vocab, byte_of = self.tokenizer.get_vocab(), {s: b for b, s in symbols.items()}
        self.inside = byte_pairs(bytes(byte_of[c] for c in t) for t in vocab if all(c in byte_of for c in t))
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        self.size[list(vocab.values())] = [len(t) for t in vocab]

    def ids(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids as little-endian uint32 bytes."""
        out = []
        for k in range(0, len(words), WORDS):
            out += self._ids(words[k : k + WORDS])
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        text = self._written(MARK.join(words))
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        # a token has a symbol for each of its bytes
        ends, reached = np.cumsum([len(w) for w in words]), np.cumsum(self.size[ids])
        stops = np.searchsorted(reached, ends) + 1
        if len(ids) != stops[-1] or (reached[stops - 1] != ends).any():  # symbols that the model doesn't have
            return [_packed([t.id for t in self.model.tokenize(self._written(w))]) for w in words]
        coded, bounds = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [coded[i:j] for i, j in zip(bounds, bounds[1:])]

    def _written(self, words: bytes) -> str:
        return self.symbols[np.frombuffer(words, np.uint8)].tobytes().decode("utf-32-le")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class LibraryEncoder:
    """Whole-text encoding with the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = tuple(a["content"].encode() for a in spec.get("added_tokens", []))
        pre = spec.get("pre_tokenizer") or {}
        # The certain cuts hold for byte-level BPE with the word pattern and no normalizer.
        self.plain = (
            spec["model"]["type"] == "BPE"
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", False)
            and spec.get("normalizer") is None
        )
        self.words = WordModel(self.model) if self.plain else None
        self.cache = BoundedCache()

    def _together(self, fragments: list[bytes]) -> list[bytes]:
        words = set(single_words(fragments))
        several = {f: SINGLE_WORD.findall(f) for f in fragments if f not in words and SEVERAL_WORDS.fullmatch(f)}
        words = list(words.union(*several.values()))
        coded = dict(zip(words, self.words.ids(words)))
        coded |= {f: b"".join([coded[w] for w in found]) for f, found in several.items()}
        return [coded[f] if f in coded else self._whole(f) for f in fragments]

    def _whole(self, text: bytes) -> bytes:
        return np.array(
            self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, dtype="<u4"
        ).tobytes()

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole UTF-8 text as little-endian uint32 bytes."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text of a slice."""
        plain = [self.plain and splits_plainly(t, self.special) for t in texts]
        ready = list(compress(texts, plain))
        coded = iter(encode_fragments(ready, self.cache, self._together, self.words.inside) if ready else [])
        return [next(coded) if p else self._whole(t) for t, p in zip(texts, plain)]


def library_encoder(path: str) -> LibraryEncoder:
    """The worker's encoder for a tokenizer file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return hold(("library", path), lambda: LibraryEncoder(path))


@lru_cache(maxsize=1)
def default_tokenizer() -> str:
    """The 50k byte-level BPE file of the public tokenizers on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
