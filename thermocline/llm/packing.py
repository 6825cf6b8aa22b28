"""Packing of tokenised documents into sequences of a fixed capacity.

A document's ids are cut into full pieces, a sequence each, and a remainder. Remainders
are dealt at random into groups of about GROUP_DOCS documents, and each group is packed on
its own by first-fit decreasing: a tournament tree over the free capacities of the bins
finds the first bin that a piece fits in. A sequence is padded to the capacity unless its
length is a power of two. The few bins that end up with more padding than MAX_PADDING are
therefore resolved: each of their remainders is cut into pieces whose lengths are powers of
two, sequences without padding. Bins with less padding keep their remainders whole.

Defined results: ids are those of the tokenizer as it is loaded, so a special token's string in a text gives that
token's id; a null or empty text has the end id alone; each repeated row is packed as
a document of its own; a null doc_id is kept; an empty table has no pieces; other columns
are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import TASK_CACHES, id_and_text
from thermocline.session import materialize

CAPACITY = 4096
END_ID = 2
GROUP_DOCS = 2048
MAX_PADDING = 64
CACHE_ENTRIES = 250_000
#: Tried in this order: the first that is one token separates words that are encoded together.
SEPARATORS = ("\u203b", "\u2603", "\u00a4", "~")
#: Letters whose lower case is one of them, that NFC leaves alone in any order, and that are no mark, digit or space.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: ASCII marks without the apostrophe, which the tokenizer's pattern takes together with some letters.
_MARKS = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}]+[{_MARKS}]*")
#: The bytes of such a word on a line of its own, its letters and its marks; else the line.
_PARTS = re.compile(
    rf"^(?:(?=[A-Za-z\xc3])([A-Za-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][A-Za-z]*)*)([{_MARKS}]*)|(.+))$".encode("latin-1"), re.MULTILINE
)  # runs of ASCII letters at once: a choice at each letter takes twice as long
_EDGE = re.compile(f"(?<=[{_LETTERS}])(?=[{_MARKS}])")
#: The steps before the merges that PlainWords knows.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
}
_END = "</w>"


class PlainWords:
    """Ids of words of Latin letters, with or without ASCII marks after them. The tokenizer's steps before the merges are
    known for these: lower case, the letters and the marks apart, bytes as characters. A tokenizer of the same merges
    without these steps gives the ids; a last symbol of its own shows where a part ends."""

    def __init__(self, tokenizer, vocabulary: dict[str, int]):
        self.tokenizer = tokenizer
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(_END)]] = True

    @classmethod
    def of(cls, path: str) -> PlainWords | None:
        """None where the tokenizer takes other steps or lacks a symbol."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ends = model.get("type") == "BPE" and model.get("end_of_word_suffix") == _END
        odd = [k for k in ("dropout", "continuing_subword_prefix", "ignore_merges") if model.get(k)]
        special = any(_PLAIN.fullmatch(t["content"]) or t["normalized"] for t in spec["added_tokens"])
        if not ends or odd or special or any(spec.get(k) != v for k, v in _STEPS.items()):
            return None
        symbols = {_symbol(b) for b in [*range(0x21, 0x7F), *range(0x80, 0xC0), 0xC3]}
        if not all(x in model["vocab"] and x + _END in model["vocab"] for x in symbols):
            return None
        bare = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        return cls(Tokenizer.from_str(json.dumps(bare)), model["vocab"])

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of words that _PLAIN matches, or of marks alone."""
        parts = "\n".join(words).lower()
        if not parts.replace("\n", "").isalpha():
            parts = _EDGE.sub(" ", parts)
        symbols = parts
        if not parts.isascii():
            symbols = parts.encode().decode("latin-1")
            for byte in (0x9F, 0xA0, 0xAD):  # in lower case, the only bytes that do not stand for themselves
                symbols = symbols.replace(chr(byte), _symbol(byte))
        ids = np.array(self.tokenizer.encode_batch_fast([symbols], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.is_end[ids])
        if len(ends) > len(words):  # some have marks apart
            ends = ends[np.cumsum([w.count(" ") + 1 for w in parts.split("\n")]) - 1]
        data, ends = ids.tobytes(), (4 * ends + 4).tolist()
        return [data[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]


def _symbol(byte: int) -> str:
    """The character that stands for a byte from 0x21 on in byte-level vocabularies."""
    if byte in (0x7F, 0xAD) or 0x80 <= byte <= 0xA0:
        return chr({0x7F: 0x121, 0xAD: 0x143}.get(byte, byte + 0xA2))
    return chr(byte)


class WordIds:
    """Ids of texts by a tokenizer that drops white space: words between ASCII spaces are encoded apart, each new one
    once and, but for plain ones, in its own case, as the tokenizer composes characters before it drops case, and kept: a full
    cache becomes the older one, whose words are taken over when they come again."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        alone = {s: self._ids([s])[0] for s in SEPARATORS}
        self.plain = PlainWords.of(path)
        self.separator, self.separator_id = next(((s, ids[0]) for s, ids in alone.items() if len(ids) == 1), (None, None))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Many words in one text, with a separator whose id tells them apart; where a word holds that id too, alone."""
        if self.separator is not None:
            ids = np.array(self._ids([f" {self.separator} ".join(words)])[0], "<u4")
            cut = np.flatnonzero(ids == self.separator_id)
            if len(cut) == len(words) - 1:
                data, starts, ends = ids.tobytes(), [0, *(4 * cut + 4).tolist()], [*(4 * cut).tolist(), 4 * len(ids)]
                return [data[i:j] for i, j in zip(starts, ends, strict=True)]
        return [np.array(x, "<u4").tobytes() for x in self._ids(words)]

    def _add(self, words: list[bytes], encode) -> None:
        for at in range(0, len(words), 512):
            part = words[at : at + 512]
            self.known.update(zip(part, encode([w.decode() for w in part]), strict=True))

    def _learn(self, words: list[bytes]) -> set[bytes]:
        """Adds the ids of words that are not known. A plain word with marks or ASCII capitals has the ids of its letters in
        lower case, which may be known, and of its marks. Returns what was added."""
        if self.plain is None:
            self._add(words, self._encode_words)
            return set(words)
        alone, made, other = [], [], []
        for word, (letters, marks, _) in zip(words, _PARTS.findall(b"\n".join(words).lower()), strict=True):
            if not letters:
                other.append(word)
            elif marks or letters != word:
                made.append((word, letters, marks))
            else:
                alone.append(word)
        self._add(other, self._encode_words)
        self._add(alone, self.plain.encode)
        parts = {letters for _, letters, _ in made}.union(marks for _, _, marks in made if marks)
        parts = {x: self.older.get(x) for x in parts.difference(self.known)}
        self.known.update((x, ids) for x, ids in parts.items() if ids is not None)
        self._add([x for x, ids in parts.items() if ids is None], self.plain.encode)
        known = self.known
        known.update([(word, known[letters] + known[marks] if marks else known[letters]) for word, letters, marks in made])
        return parts.keys() | words

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [t.encode().split() for t in texts]
        flat = list(chain.from_iterable(words))
        ids = list(map(self.known.get, flat))
        gaps = list(compress(range(len(ids)), map(is_, ids, repeat(None))))
        fresh = list({flat[k] for k in gaps})
        if len(self.known) + len(fresh) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        if self.older:
            again = list(map(self.older.get, fresh))
            self.known.update([(word, x) for word, x in zip(fresh, again, strict=True) if x is not None])
            fresh = [word for word, x in zip(fresh, again, strict=True) if x is None]
        added = self._learn(fresh) if fresh else ()
        known = self.known
        for k in gaps:
            ids[k] = known[flat[k]]
        for word in added:
            if len(word) > 64:
                del known[word]
        ends = np.cumsum([len(w) for w in words]).tolist()
        return [b"".join(ids[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]


_TOKENIZERS: dict[str, WordIds] = {}
TASK_CACHES.append(_TOKENIZERS)  # the tasks here keep it for the next; those of other operators drop it


def word_ids(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _ids(batches, path: str):
    """Batches of at most 256 rows with their ids, the end id included."""
    tokenizer, end = word_ids(path), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [t or "" for t in part.column("text").to_pylist()]
            # the words of a few texts at a time stay in fast memory
            yield part, [x + end for k in range(0, len(texts), 32) for x in tokenizer.encode(texts[k : k + 32])]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per document row: row, doc_id, doc_tokens, and the CRC-32 of its full pieces, of its
    remainder and of the remainder's pieces of power-of-two lengths."""

    def run(batches):
        for part, encoded in _ids(batches, path):
            full, rest, parts = [], [], []
            for ids in encoded:
                cut = len(ids) // (4 * capacity) * 4 * capacity
                full.append([zlib.crc32(ids[i : i + 4 * capacity]) for i in range(0, cut, 4 * capacity)])
                tail, at = ids[cut:], 0
                rest.append(zlib.crc32(tail))
                own = []
                for n in powers(len(tail) // 4):
                    own.append(zlib.crc32(tail[4 * at : 4 * (at + n)]))
                    at += n
                parts.append(own)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array([len(x) // 4 for x in encoded], pa.int64()),
                 pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                names=["row", "doc_id", "doc_tokens", "full_crc", "rest_crc", "parts_crc"],
            )

    rows = id_and_text(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(run, "row long, doc_id long, doc_tokens long, full_crc array<long>, rest_crc long, parts_crc array<long>")


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin of each size and free capacity of each bin. A node of the tournament tree holds the
    largest free capacity below it; going left where it suffices finds the first bin that fits."""
    n = 1
    while n < len(sizes):
        n *= 2
    tree = [capacity] * (2 * n)
    bins, used = [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, k = sizes[i], 1
        while k < n:
            k *= 2
            if tree[k] < size:
                k += 1
        bins[i] = k - n
        used = max(used, k - n + 1)
        tree[k] -= size
        k //= 2
        while k:
            tree[k] = max(tree[2 * k], tree[2 * k + 1])
            k //= 2
    return bins, tree[n : n + used]


def pack_group(group: pd.DataFrame, capacity: int, max_padding: int) -> pd.DataFrame:
    """Pieces of one group; sequences are numbered within the group."""
    group = group.sort_values("row")
    ids, tokens = group["doc_id"].tolist(), group["doc_tokens"].tolist()
    out, seq = [], 0
    for i, total, crcs in zip(ids, tokens, group["full_crc"], strict=True):
        for k, crc in enumerate(crcs):
            out.append((i, k * capacity, capacity, crc, total, seq, 0))
            seq += 1
    at = [k for k, total in enumerate(tokens) if total % capacity]
    sizes = [tokens[k] % capacity for k in at]
    rest, parts = group["rest_crc"].tolist(), group["parts_crc"].tolist()
    bins, free = first_fit_decreasing(sizes, capacity)
    loose = {b for b, f in enumerate(free) if f > max_padding and (capacity - f) & (capacity - f - 1)}
    place, number = [0] * len(free), {}
    for k, size, b in sorted(zip(at, sizes, bins, strict=True), key=lambda x: (x[2], -x[1])):
        i, total = ids[k], tokens[k]
        start = total - size
        if b in loose:
            for n, crc in zip(powers(size), parts[k], strict=True):
                out.append((i, start, n, crc, total, seq, 0))
                start, seq = start + n, seq + 1
        else:
            if b not in number:
                number[b], seq = seq, seq + 1
            out.append((i, start, size, rest[k], total, number[b], place[b]))
            place[b] += size
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "in_group", "offset"]
    return pd.DataFrame(out, columns=names).astype({n: "Int64" for n in names})


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, max_padding: int = MAX_PADDING, seed: int = 7
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    pieces = materialize(token_pieces(docs, path, capacity), "token-pieces")
    groups = max(1, -(-pieces.count() // group_docs))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)).cast("long"))

    def pack(key, group):
        return pack_group(group, capacity, max_padding).assign(group=int(key[0]))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, in_group long, offset long, group long"
    packed = dealt.groupBy("group").applyInPandas(pack, schema)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("group") * F.lit(2**32) + F.col("in_group")).alias("sequence_id"), "offset")


def packed_sequences(docs: DataFrame, packed: DataFrame, path: str) -> DataFrame:
    """sequence_id and ids of every sequence of ``packed``, without padding (doc_id must be unique)."""

    def run(batches):
        for part, encoded in _ids(batches, path):
            ids = pa.array([np.frombuffer(x, "<u4").astype("i4") for x in encoded], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    ids = id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")
    cut = packed.join(ids, "doc_id").select("sequence_id", F.struct("offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids")).alias("piece"))
    parts = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # at most a sequence's capacity
    return parts.select("sequence_id", F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids"))
