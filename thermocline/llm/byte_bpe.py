"""Byte-level BPE encoding and decoding with a given table of ranks.

A text is split by the tokenizer's pattern; each match is encoded separately. Within a
match, a segment tree over the byte positions holds the rank of the pair that starts at
each live position; its root is the leftmost least rank. A merge changes three leaves
(the merged position, its right neighbour, its left neighbour), each a logarithmic
update, so that a match of n bytes takes O(n log n).

Defined results: a null or empty text has no tokens; repeated rows are encoded alike; an
empty table gives an empty result; other columns are ignored. Surrogates cannot occur in
a Spark string.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thermocline.llm.common import id_and_text

NO_PAIR = 1 << 60
#: Entries of the two per-process caches (pieces between spaces, matches); a full cache is emptied.
CACHE_ENTRIES = 400_000
#: A space beside other white space, and one that is not; what re takes as white space holds all that the pattern does.
WIDE_SPACE = re.compile(r" \s|[^\S ] ")
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match."""
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    size = 1
    while size < n:
        size *= 2
    # tree[1] is the root, leaf i is at size + i; a node holds rank * size + position
    tree = [NO_PAIR] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    end = list(range(1, n + 1))  # end of the token that starts here, which is the next live start
    before = list(range(-1, n - 1))  # the previous live start

    def update(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return
            tree[k] = least
            k >>= 1

    while tree[1] < NO_PAIR:
        i = tree[1] % size
        right = end[i]
        stop = end[right]
        end[i] = stop
        update(right, NO_PAIR)
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            update(i, NO_PAIR if rank is None else rank * size + i)
        else:
            update(i, NO_PAIR)
        if i:
            left = before[i]
            rank = ranks.get(piece[left:stop])
            update(left, NO_PAIR if rank is None else rank * size + left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class ByteBpe:
    """Encoder and decoder for one rank file and pattern; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.tokens = np.empty(max(self.ranks.values()) + 1, dtype=object)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.split = regex.compile(pattern).findall
        self.matches: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _match(self, match: str) -> bytes:
        ids = self.matches.get(match)
        if ids is None:
            ids = np.array(merge_bytes(match.encode(), self.ranks), "<u4").tobytes()
            if len(match) <= 64:
                if len(self.matches) >= CACHE_ENTRIES:
                    self.matches.clear()
                self.matches[match] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = b"".join([self._match(m) for m in self.split(piece)])
        if len(piece) <= 64:
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text. No match reaches over a single space between other characters than white space, so that
        a text is the sequence of its pieces between such spaces."""
        first, *rest = (SINGLE_SPACE.split(text) if WIDE_SPACE.search(text) else text.split(" "))
        known = self.pieces.get
        out = [self._piece(first)]
        for word in rest:
            piece = " " + word
            out.append(known(piece) or self._piece(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


_CODECS: dict[tuple[str, str], ByteBpe] = {}


def codec(path: str, pattern: str) -> ByteBpe:
    """The process's codec for a rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


def _per_text(fn: Callable[[ByteBpe, str], tuple], path: str, pattern: str, names: list[str], types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), *zip(names, types, strict=True)])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [fn(bpe, t.as_py()) for t in part.column("text")]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema=schema)

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every text."""
    run = _per_text(lambda bpe, text: (bpe.encode(text),), path, pattern, ["ids"], [pa.binary()])
    return id_and_text(docs).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of rows (doc_id, ids)."""

    def run(batches):
        bpe = codec(path, pattern)
        for batch in batches:
            texts = pa.array([None if x.as_py() is None else bpe.decode(x.as_py()) for x in batch.column("ids")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the bytes that they decode to."""

    def digest(bpe: ByteBpe, text: str) -> tuple:
        ids = bpe.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()

    run = _per_text(digest, path, pattern, ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()])
    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
