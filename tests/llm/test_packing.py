from __future__ import annotations

import json
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from thermocline.llm.packing import PlainWords, WordIds, first_fit_decreasing, pack_documents, packed_sequences, word_ids

PATH = P.path("word_bpe_49k.json")


def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, texts, capacity):
    ids = {i: reference()(t) for i, t in texts.items()}
    seen, seqs = {i: 0 for i in ids}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id] += r.length
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, part.tolist()))
    assert seen == {i: len(x) for i, x in ids.items()}
    padding, out = 0, {}
    for s, parts in seqs.items():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
        out[s] = [x for _, _, part in sorted(parts) for x in part]
    return padding, out


def test_words_apart_encode_like_whole_texts():
    rng, one = random.Random(3), reference()
    words = ["The", "it's", "naïve", "Ünïcodé", "123", "a,b!!", "<|endoftext|>", "x<|endoftext|>y", "<|ENDOFTEXT|>", "漢字", "😀", "\x1c", " x", "é", " ", "ＡＢ"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t\r\n", "\x0b\x0c", ""]) for _ in range(rng.randrange(12))) for _ in range(800)]
    got = word_ids(PATH).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == one(text)[:-1], repr(text)


def test_capitals_with_marks_encode_like_whole_texts():
    """Composition comes before lower case: some capitals have no composed form; a plainly loaded tokenizer agrees."""
    rng, plain = random.Random(4), Tokenizer.from_file(PATH)
    texts = ["H\u0331a", "T\u0308", "J\u030c", "\u0331 H"]
    texts += ["".join(rng.choices("AHJTWYhjtwyIK\u0331\u0308\u030c\u030a\u0307\u0130 ", k=rng.randrange(40))) for _ in range(800)]
    for text, ids in zip(texts, word_ids(PATH).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_plain_words_encode_like_the_whole_tokenizer(tmp_path):
    """Words of Latin letters with marks after them skip the tokenizer's first steps, which take most of its time."""
    rng, plain, one = random.Random(6), PlainWords.of(PATH), Tokenizer.from_file(PATH)
    latin = [c for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]) if c.isalpha()]
    marks = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'"]
    words = latin + ["a" + c for c in marks] + ["".join(rng.choices(latin, k=rng.randrange(1, 12)) + rng.choices(marks, k=rng.choice([0, 0, 1, 2, 3]))) for _ in range(3000)]
    for word, ids in zip(words, plain.encode(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == one.encode(word, add_special_tokens=False).ids, repr(word)
    other = tmp_path / "cased.json"
    other.write_text(json.dumps(json.loads(Path(PATH).read_text()) | {"normalizer": {"type": "NFC"}}))
    assert PlainWords.of(str(other)) is None
    cased = Tokenizer.from_file(str(other))
    assert [np.frombuffer(x, "<u4").tolist() for x in word_ids(str(other)).encode(words)] == [cased.encode(w, add_special_tokens=False).ids for w in words]


def test_known_letters_are_not_encoded_again(monkeypatch):
    """A word with marks or in capitals takes the ids of its letters where these are known; long words are not kept."""
    words, one, asked = WordIds(PATH), reference(), []
    words.encode(["alpha beta"])
    encode = words.plain.encode
    monkeypatch.setattr(words.plain, "encode", lambda some: asked.extend(some) or encode(some))
    text = "Alpha, BETA! alpha. (beta) Gamma, GAMMA " + "Ab" * 50 + "! \u00c9t\u00c9; it's <|endoftext|> a<|endoftext|>"
    for _ in range(2):
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == one(text)[:-1]
        assert not any(len(w) > 64 for w in words.known)
    assert not {"alpha", "beta"} & {w.lower().strip(",.!") for w in asked} and asked.count("gamma") == 1
    words.older, words.known = words.known, {}
    asked.clear()
    assert np.frombuffer(words.encode(["ALPHA. delta, gamma"])[0], "<u4").tolist() == one("ALPHA. delta, gamma")[:-1]
    assert asked == ["delta"]


def test_parts_of_words():
    """Words are taken apart in their bytes as the pattern of plain words has it."""
    from thermocline.llm.packing import _PARTS, _PLAIN

    rng, some = random.Random(7), [chr(c) for c in [*range(0x21, 0x180), 0x301, 0x3B1, 0x2019]]
    words = ["".join(rng.choices(some, k=rng.randrange(1, 4))) for _ in range(20_000)]
    for word, (letters, marks, rest) in zip(words, _PARTS.findall("\n".join(words).encode()), strict=True):
        assert (letters + marks or rest).decode() == word and bool(letters) == bool(_PLAIN.fullmatch(word))


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(5)
    sizes = [rng.randrange(1, 100) for _ in range(300)]
    bins, free = first_fit_decreasing(sizes, 100)
    want, room = {}, []
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if k == len(room):
            room.append(100)
        room[k] -= sizes[i]
        want[i] = k
    assert bins == [want[i] for i in range(300)] and free == room
    assert first_fit_decreasing([], 100) == ([], [])


def test_pieces(make_docs):
    texts = {1: "a b c", 2: None, 3: "", 4: "word " * 700, 5: "x", 6: "some more words here " * 9}
    docs = make_docs(list(texts.items())).selectExpr("*", "1 AS row", "2 AS `group`")
    packed = pack_documents(docs, PATH, capacity=64, group_docs=3, max_padding=4)
    padding, seqs = check_pieces(packed.collect(), texts, 64)
    assert padding <= 4 * len(seqs)
    assert {r.sequence_id: r.ids for r in packed_sequences(docs, packed, PATH).collect()} == seqs
    assert pack_documents(docs.limit(0), PATH).count() == 0
    twice = make_docs([(1, "a"), (1, "a"), (None, "b")])
    assert sorted(str((r.doc_id, r.length)) for r in pack_documents(twice, PATH).collect()) == ["(1, 2)", "(1, 2)", "(None, 2)"]


def test_table(spark):
    from thermocline.llm.queries import QUERIES

    texts = dict(duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall())
    padding, seqs = check_pieces(QUERIES["op8_packing"](spark, "/root/testdata/sf0.001").collect(), texts, 4096)
    assert padding <= 0.02 * sum(map(len, seqs.values()))
