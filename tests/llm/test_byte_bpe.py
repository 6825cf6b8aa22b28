from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from thermocline.llm.byte_bpe import ByteBpe, decode_documents, encode_documents, read_ranks, round_trip_digests

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


TEXTS = ["", " ", "  ", "a  b", "a   b\n\n  c \t\n d ", "it's we'll 12 345 ...!?  x", "naïve Straße 漢字 😀😀 \x00   　 x",
         "x" * 5000, "ab" * 3000, " " * 1000 + "y", "a \n  b", "a \n b", "tail \n", "tail  "]


def test_same_ids_as_tiktoken(known):
    bpe, rng = ByteBpe(PATH, P.PATTERN), random.Random(1)
    alphabet = list("ab eE.,'sl\n\t  1é漢😀 \x1c")
    for text in TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]:
        ids = bpe.encode(text)
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == known.encode_ordinary(text), repr(text)
        assert bpe.decode(ids) == text.encode()


def test_white_space_beside_spaces(known):
    """A run of spaces and other white space is one match."""
    bpe, rng = ByteBpe(PATH, P.PATTERN), random.Random(2)
    alphabet = ["a", "1", ".", " ", " ", "\u00a0", " \u00a0 \u00a0", "\t", "\u2003", "\n", "\x85", "\x1c", "\u3000"]
    for text in ["Price \u00a0 \u00a0 \u00a0 10", " a", "a ", "\u00a0 b c"] + ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(5000)]:
        ids = bpe.encode(text)
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == known.encode_ordinary(text), repr(text)


def test_documents(make_docs, known):
    docs = make_docs([(1, "a b c"), (1, "a b c"), (2, None), (None, "x"), *((10 + k, t) for k, t in enumerate(TEXTS))])
    got = round_trip_digests(docs, PATH, P.PATTERN).collect()
    assert len(got) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got if r.doc_id == 2} == {(0, empty, empty)}
    texts = {10 + k: t for k, t in enumerate(TEXTS)}
    for r in got:
        if r.doc_id in texts:
            assert r.n_tokens == len(known.encode_ordinary(texts[r.doc_id]))
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    back = decode_documents(encode_documents(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((r.text or "").encode() for r in docs.collect())
    assert round_trip_digests(docs.limit(0), PATH, P.PATTERN).count() == 0
