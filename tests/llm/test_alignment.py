"""Token alignment against a plain comparison of spans."""

from __future__ import annotations

import hashlib
import os
import random
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_frames import ODD_ROWS, make_docs  # noqa: E402

from playlens.llm import alignment, queries  # noqa: E402
from playlens.llm.libtokens import byte_symbols, default_tokenizer  # noqa: E402

SF001 = "/root/testdata/sf0.001"


class Plain:
    """Whole texts through both libraries, spans compared one by one."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(default_tokenizer())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=alignment.default_pieces())
        self.bytes = {s: b for b, s in byte_symbols().items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.bytes[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x[1] for x in a) != whole or b"".join(x[1] for x in b) != whole:
            return [], []
        return a, b

    @staticmethod
    def spans(tokens):
        out, at = [], 0
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def row(self, text):
        a, b = map(self.spans, self.tokens(text))
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        low, groups = 0, []
        for c in cuts:
            inside = lambda side: ",".join(str(i) for i, s, _ in side if low <= s < c)  # noqa: E731, B023
            groups.append(f"{inside(a)}|{inside(b)}")
            low = c
        return len(a), len(b), groups, links


def brute(rows):
    plain = Plain()
    found = [plain.row(t) for _, t in rows]
    held = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(n, best.get(a, 0))
    out = []
    for (doc_id, _), (n_a, n_b, groups, links) in zip(rows, found):
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(held[p] == best[p[0]] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(held[p] for p in links), sha))
    return sorted(out, key=repr)


def got(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_odd_rows(spark):
    rows = [r[:2] for r in ODD_ROWS] + [(20, "a▁b"), (21, "tail "), (22, " lead"), (23, "  two  spaces  "), (24, " x 　y"), (25, "a\x00b"), (26, "x\n y\t z"), (27, "A b" * 300)]
    assert got(alignment.align_documents(make_docs(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert alignment.align_documents(make_docs(spark, [])).count() == 0


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert got(queries.op13_token_alignment(spark, SF001)) == brute(rows)


def test_many_blocks_share_counts(spark, monkeypatch):
    """Counts are of the whole corpus, however the documents are dealt to blocks."""
    rng = random.Random(2)
    words = ["token", "Alignment", "naïve", "漢字", "<|endoftext|>", "</s>", "x1", "\n", "don't", "😀", "　", "é"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(300)]
    docs = make_docs(spark, rows).repartition(7)
    assert got(alignment.align_documents(docs)) == brute(rows)


def test_fragments_equal_whole_texts():
    rng = random.Random(4)
    plain, encoders = Plain(), alignment.TwoEncoders(default_tokenizer(), alignment.default_pieces())
    pool = [" ", " ", " ", "  ", "a", "B", "z.", "'s", "1", "\n", "\t", "\r", "é", "ß", "漢", " ", " ", "😀", "<s>", "▁", "~", "\x01", "。", "ﬁ", "é"]
    for _ in range(1500):
        text = "".join(rng.choices(pool, k=rng.randint(1, 14)))
        a, b = plain.tokens(text)
        found = encoders.encode(text.encode())
        if found is None:
            assert (a, b) == ([], []), text
        else:
            import numpy as np

            assert [np.frombuffer(x, "<u4").tolist() for x in found] == [[i for i, _ in a], [i for i, _ in b]], text


def test_a_slice_of_texts_equals_whole_texts():
    """Accented words, signs, contractions and rare pairs of letters, with texts that don't split plainly."""
    import numpy as np

    rng = random.Random(8)
    plain, encoders = Plain(), alignment.TwoEncoders(default_tokenizer(), alignment.default_pieces())
    pool = [" ", " ", "\n", ".", ",", "'", "'s", "'ve", "#", "##", "-", "%", "1", "22", "qx", "jvz", "fq", "s", "the", "é", "ç", "É", "ŉ", "ſ", "\t", "  ", "漢"]
    texts = ["".join(rng.choices(pool[:24] if i % 4 else pool, k=rng.randint(0, 9))) for i in range(6000)]
    for limit in (encoders.limit, 4000, 0):
        encoders.limit = limit
        for k in range(0, len(texts), 1500):
            part = texts[k : k + 1500]
            sides, _ = encoders.encode_all([t.encode() for t in part])
            bounds = [np.searchsorted(doc, np.arange(len(part) + 1)) for _, doc in sides]
            for i, text in enumerate(part):
                found = [ids[at[i] : at[i + 1]].tolist() for (ids, _), at in zip(sides, bounds)]
                assert found == [[x for x, _ in tokens] for tokens in plain.tokens(text)], text


def test_new_fragments_of_a_slice_reach_the_libraries_together():
    """Accented word ends are cut, so that words and not runs of words are kept; known ones need no call."""
    encoders, calls = alignment.TwoEncoders(default_tokenizer(), alignment.default_pieces()), []
    inner = encoders._together
    encoders._together = lambda fragments: calls.append(len(fragments)) or inner(fragments)
    words = ["été", "passé", "né", "idé", "café"]
    rng = random.Random(5)
    texts = [" ".join(rng.choices(words, k=8)).encode() for _ in range(300)]
    first = alignment.align(texts, encoders)["groups"]
    assert len(calls) == 1 and calls[0] <= 6 * len(words)
    assert alignment.align(texts, encoders)["groups"] == first and len(calls) == 1
