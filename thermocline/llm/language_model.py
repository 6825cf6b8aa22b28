"""Language-model scores by context-tree weighting over bytes.

A text is its bytes with A-Z lower-cased and one end symbol. Each byte is eight binary
decisions; a node is a context of the last 0 to DEPTH bytes together with the bits decided so
far. Training counts the zeros and ones at each node of all training texts. The weighted
probability of a node mixes its Krichevsky-Trofimov estimate with the product of its
children's, one half each (a deepest node has the estimate alone); from these follow the
weights with which the estimates of all depths along a context mix into the probability of
the next bit.

The counts grow with the corpus and stay distributed. A block is a run of rows of an input file
(other input is written to files first), so that reading forms the blocks without a shuffle: so
many rows as hold BLOCK_BYTES on average; runs that hold far more are cut by the running sum
of their bytes, so that no block has more than 5/4 of BLOCK_BYTES unless it is one text. A block gives its distinct (context, byte) grams and words with their training counts; the counts
are summed by gram and by word; the tree below a context of three bytes is worked out
where its grams are; the level of two bytes is summed from those trees and comes back to each
of them by a join, only the nodes that it needs; the levels of one byte and none, at most 256
contexts by 255 nodes whatever the corpus, go through the driver to all tasks; and each block
gets back the values of its own grams and words, and then its texts, which are scored a few at a time.

Defined results: a null or empty text is its end symbol alone; repeated rows count and score
each; a null doc_id is held out or not by the crc32 of the empty text; without training
rows every bit has probability 1/2; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import id_and_text
from thermocline.llm.shingles import distinct, word_hashes
from thermocline.session import materialize

DEPTH = 5
#: Bytes of text in a block, on average, and rows of a block at most.
BLOCK_BYTES = 32 << 20
BLOCK_ROWS = 1 << 18
CHUNK_BYTES = 1 << 20
#: Keys that are gathered before they are summed up again.
MERGE_KEYS = 1_000_000
#: Grams whose trees one task works out.
TREE_GRAMS = 200_000
GRAM, WORD, TOTAL, TEXT = 0, 1, 2, 3



def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def grams_of(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Key of each byte: the DEPTH bytes before it, nearest first, and itself; 0 before a text's start."""
    key = data.astype(np.int64)
    own = key.copy()
    for d in range(1, DEPTH + 1):
        key[d:] |= own[:-d] << (8 * (DEPTH + 1 - d))
    starts = np.cumsum(lengths) - lengths
    for since in range(DEPTH):
        key[starts[lengths > since] + since] &= 255 | ((1 << (8 * since)) - 1) << (8 * (DEPTH + 1 - since))
    return key


def _chunks(texts: list[str]):
    """A few texts at a time: (position of the first, bytes of each, grams, words of each, word hashes)."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size < CHUNK_BYTES):
            size += len(texts[stop]) + 1
            stop += 1
        raw = [t.encode().lower() for t in texts[at:stop]]
        lengths = np.array([len(r) + 1 for r in raw])
        words = [r.split() for r in raw]
        hashes = word_hashes([w for x in words for w in x]).view(np.int64)
        yield at, lengths, grams_of(np.frombuffer(b"\0".join(raw) + b"\0", np.uint8), lengths), np.array([len(w) for w in words]), hashes
        at = stop


class Counts:
    """Sorted distinct keys with counts, summed up whenever MERGE_KEYS have come."""

    def __init__(self):
        self.parts, self.waiting = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def add(self, keys: np.ndarray, learn: np.ndarray) -> None:
        key, trained = distinct(keys), np.sort(keys[learn])
        self.parts.append((key, np.searchsorted(trained, key, "right") - np.searchsorted(trained, key)))
        self.waiting += len(key)
        if self.waiting > MERGE_KEYS:
            self.parts, self.waiting = [self.summed()], 0

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        key = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(key, kind="stable")
        key, n = key[order], np.concatenate([n for _, n in self.parts])[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        return key[first], np.add.reduceat(n, first) if len(first) else n


class Block:
    """Training counts of the distinct grams and words of a block, and its training texts."""

    def __init__(self, block: int):
        self.block, self.grams, self.words, self.learnt = block, Counts(), Counts(), 0

    def add(self, ids: list, texts: list[str]) -> None:
        learn = np.array([not is_held_out(i) for i in ids])
        self.learnt += int(learn.sum())
        for at, lengths, keys, counts, hashes in _chunks(texts):
            own = learn[at : at + len(lengths)]
            self.grams.add(keys, np.repeat(own, lengths))
            self.words.add(hashes, np.repeat(own, counts))

    def rows(self):
        """block, kind, key, n, sorted by kind and key, up to MERGE_KEYS rows at a time."""
        for kind, keys, n in ((GRAM, *self.grams.summed()), (WORD, *self.words.summed()), (TOTAL, np.zeros(1, np.int64), np.array([self.learnt]))):
            for at in range(0, len(keys), MERGE_KEYS):
                key, own = keys[at : at + MERGE_KEYS], n[at : at + MERGE_KEYS]
                columns = [np.full(len(key), self.block), np.full(len(key), kind, np.int32), key, own.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "kind", "key", "n"])


def _runs(batches):
    """(block, rows) for each run of rows of one block in a batch."""
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield int(blocks[a]), batch.slice(a, b - a)


def _count_blocks(batches):
    """Counts of each run of rows of one block."""
    now = None
    for block, part in _runs(batches):
        if now is None or block != now.block:
            if now is not None:
                yield from now.rows()
            now = Block(block)
        for at in range(0, part.num_rows, 512):
            some = part.slice(at, 512)
            now.add(some.column("doc_id").to_pylist(), some.column("text").to_pylist())
    if now is not None:
        yield from now.rows()


class Values:
    """Values of the grams and words of one block, looked up in sorted arrays."""

    def __init__(self):
        self.parts, self.sorted = {GRAM: [], WORD: []}, {}

    def add(self, kind: np.ndarray, key: np.ndarray, value: np.ndarray) -> None:
        """Rows in order of kind."""
        at = int(np.searchsorted(kind, WORD))
        self.parts[GRAM].append((key[:at].astype(np.int64), value[:at].copy()))
        self.parts[WORD].append((key[at:].astype(np.int64), value[at:].copy()))

    def of(self, kind: int, keys: np.ndarray) -> np.ndarray:
        if kind not in self.sorted:
            parts = self.parts.pop(kind)
            key = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in parts]])
            order = np.argsort(key)
            self.sorted[kind] = key[order], np.concatenate([np.zeros(0), *[v for _, v in parts]])[order]
        (of, values), order, out = self.sorted[kind], np.argsort(keys), np.empty(len(keys))
        at = np.minimum(np.searchsorted(of, keys[order]), len(of) - 1)  # in order, so that look-ups are near each other
        if len(keys) and not (len(of) and np.array_equal(of[at], keys[order])):
            raise RuntimeError("a block's values are not complete")
        out[order] = values[at] if len(keys) else out
        return out


_LOG_GAMMA = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 4096)))])  # ln (n!)
_LOG_HALVES = np.concatenate([[0.5 * math.log(math.pi)], 0.5 * math.log(math.pi) + np.cumsum(np.log(np.arange(4095) + 0.5))])  # ln Gamma(n + 1/2)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    half = lambda n: np.where(n < 4096, _LOG_HALVES[np.minimum(n, 4095)], _log_gamma(n + 0.5))
    n = zeros + ones
    whole = np.where(n < 4096, _LOG_GAMMA[np.minimum(n, 4095)], _log_gamma(n + 1.0))
    return half(zeros) + half(ones) - whole - math.log(math.pi)


def _weigh(own: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Logarithm of the mixture of a node's own estimate and the product of its children."""
    return np.logaddexp(own, children) - math.log(2)


class Level:
    """Nodes of one depth: sorted keys with counts, weighted probability and the weight of stopping there."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None = None):
        self.key, self.zeros, self.ones = key, zeros, ones
        own = log_kt(zeros, ones)
        self.weighted = own if children is None else _weigh(own, children)
        self.stop = np.exp(own - self.weighted) * (1.0 if children is None else 0.5)

    def up(self, shift) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums over the nodes of equal ``shift(key)``: the level above."""
        key, at = np.unique(shift(self.key), return_inverse=True)
        total = lambda x: np.bincount(at, x, minlength=len(key))
        return key, total(self.zeros).astype(np.int64), total(self.ones).astype(np.int64), total(self.weighted)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimate that the bit is one and weight of stopping, at nodes that need not be known."""
        if not len(self.key):
            return np.full(len(key), 0.5), np.full(len(key), 0.5)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key
        one = (self.ones[at] + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        return np.where(known, one, 0.5), np.where(known, self.stop[at], 0.5)


def _drop_byte(key: np.ndarray) -> np.ndarray:
    """Node key (context bytes nearest first, then 8 bits of node) without its farthest context byte."""
    return (key >> 16 << 8) | (key & 255)


def node_counts(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, zeros, ones) of the deepest nodes."""
    context, byte = grams >> 8, grams & 255
    keys, bits = [], []
    for b in range(8):
        keys.append(context << 8 | (1 << b) | byte >> (8 - b))
        bits.append(byte >> (7 - b) & 1)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    n, bit = np.tile(counts, 8), np.concatenate(bits)
    ones = np.bincount(at, n * bit, minlength=len(key)).astype(np.int64)
    return key, np.bincount(at, n, minlength=len(key)).astype(np.int64) - ones, ones


def deep_levels(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The levels from depth 3 to DEPTH below the contexts of the grams."""
    seen = counts > 0
    levels = [Level(*node_counts(grams[seen], counts[seen]))]
    for _ in range(DEPTH - 3):
        levels.insert(0, Level(*levels[0].up(_drop_byte)))
    return levels


def top_levels(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> list[Level]:
    """The levels of depth 0 and 1, from the sums over depth 2."""
    order = np.argsort(key)
    one = Level(key[order], zeros[order], ones[order], children[order])
    return [Level(*one.up(_drop_byte)), one]


def gram_scores(grams: np.ndarray, counts: np.ndarray, upper: list[Level]) -> np.ndarray:
    """log10 probability of each gram's byte after its context; ``upper`` are the levels of depth 0 to 2."""
    levels = [*upper, *deep_levels(grams, counts)]
    context, byte = grams >> 8, grams & 255
    out = np.zeros(len(grams))
    for b in range(8):
        node, bit = (1 << b) | byte >> (8 - b), byte >> (7 - b) & 1
        chance, rest = np.zeros(len(grams)), np.ones(len(grams))
        for depth, level in enumerate(levels):
            one, stop = level.find(context >> (8 * (DEPTH - depth)) << 8 | node)
            stop = np.ones(len(grams)) if depth == DEPTH else stop
            chance += rest * stop * one
            rest *= 1 - stop
        out += np.log10(np.where(bit == 1, chance, 1 - chance))
    return out


def fit_grams(counts: DataFrame) -> DataFrame:
    """(key, value): log10 probability of every gram of ``counts`` (key, n)."""
    parts = max(4, -(-counts.count() // TREE_GRAMS))
    dealt = counts.withColumn("part", F.pmod(F.xxhash64(F.shiftrightunsigned("key", 8 * (DEPTH - 2))), F.lit(parts)))  # by the nearest three bytes

    def below(rows: pd.DataFrame) -> pd.DataFrame:
        grams, counts = rows["key"].to_numpy(), rows["n"].to_numpy()
        key = node_counts(grams >> 8 * (DEPTH - 1) << 8 | grams & 255, np.zeros(len(grams), np.int64))[0]
        out = pd.DataFrame({"part": rows["part"].iloc[0], "key": key, "zeros": 0, "ones": 0, "weighted": 0.0})
        seen, *sums = deep_levels(grams, counts)[0].up(_drop_byte)
        for name, x in zip(["zeros", "ones", "weighted"], sums, strict=True):  # grams that training lacks need their nodes too
            out.loc[np.searchsorted(key, seen), name] = x
        return out

    def above(batches):
        for two in batches:
            key, zeros, ones, weighted = Level(*[two[c].to_numpy() for c in ("key", "zeros", "ones", "weighted")]).up(_drop_byte)
            yield pd.DataFrame({"key": key, "zeros": zeros, "ones": ones, "weighted": weighted})

    nodes = "key long, zeros long, ones long, weighted double"
    sums = [F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]
    parents = materialize(dealt.groupBy("part").applyInPandas(below, "part long, " + nodes), "tree-parents")
    two = materialize(parents.groupBy("key").agg(*sums), "tree-two")
    one = two.mapInPandas(above, nodes).groupBy("key").agg(*sums).toArrow()  # at most 256 contexts of one byte by 255 nodes
    shared = counts.sparkSession.sparkContext.broadcast(top_levels(*[one.column(c).to_numpy() for c in ("key", "zeros", "ones", "weighted")]))
    needed = parents.select("part", "key").join(two, "key")

    def scored(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("key")
        level = Level(*[own[c].to_numpy() for c in ("key", "zeros", "ones", "weighted")])
        key = rows["key"].to_numpy()
        return pd.DataFrame({"key": key, "value": gram_scores(key, rows["n"].to_numpy(), [*shared.value, level])})

    return dealt.groupBy("part").cogroup(needed.groupBy("part")).applyInPandas(scored, "key long, value double")


def in_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, text, block) of every row: a block is a run of rows of a file. Runs are of the same length
    everywhere; those of more than 5/4 of ``block_bytes`` are cut by _cut."""
    if not _from_files(docs):
        docs = materialize(id_and_text(docs), "documents")
    size = docs.agg(F.avg(F.octet_length(F.coalesce("text", F.lit(""))) + 1)).first()[0] or 1
    rows = max(1, min(BLOCK_ROWS, int(block_bytes / size)))
    index, run = F.col("_metadata.row_index"), ["file", "run"]
    columns = [F.col("_metadata.file_path").alias("file"), F.floor(index / rows).alias("run"), F.pmod(index, F.lit(rows)).alias("place")]
    sizes = docs.select(*columns, (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"))
    heavy = materialize(sizes.groupBy(*run).agg(F.sum("size").alias("bytes")).where(F.col("bytes") > block_bytes + block_bytes // 4), "heavy-runs")
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *columns)
    if heavy.isEmpty():
        return placed.select("doc_id", "text", F.xxhash64(*run).alias("block"))

    def cuts(key, group):
        group = group.sort_values("place")
        return pd.DataFrame({"file": [key[0]], "run": [key[1]], "cuts": [_cut(group["place"].tolist(), group["size"].tolist(), block_bytes)]})

    # heavy runs are at most one for each 5/4 of block_bytes of the table
    found = sizes.join(F.broadcast(heavy.select(*run)), run).groupBy(*run).applyInPandas(cuts, "file string, run long, cuts array<long>")
    placed = placed.join(F.broadcast(materialize(found, "block-cuts")), run, "left")
    part = F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("place"))), F.lit(0))
    return placed.select("doc_id", "text", F.when(F.col("cuts").isNull(), F.xxhash64(*run)).otherwise(F.xxhash64(*run, part)).alias("block"))


def _cut(places: list[int], sizes: list[int], block_bytes: int) -> list[int]:
    """Places at which a new block begins, so that none has more than ``block_bytes`` unless it is one row."""
    out, total = [], 0
    for place, size in zip(places, sizes, strict=True):
        if total and total + size > block_bytes:
            out.append(place)
            total = 0
        total += size
    return out


def _from_files(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte of every row."""
    placed = in_blocks(docs, block_bytes)
    seen = materialize(placed.mapInArrow(_count_blocks, "block long, kind int, key long, n int"), "block-counts")
    counts = materialize(seen.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    ends = counts.where(F.col("kind") == TOTAL).agg(F.sum("n")).first()[0] or 0
    words = counts.where((F.col("kind") == WORD) & (F.col("n") > 0)).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = (words.n or 0) + ends, words.v + (ends > 0)
    grams = materialize(fit_grams(counts.where(F.col("kind") == GRAM).select("key", "n")), "gram-scores")
    values = grams.select(F.lit(GRAM).alias("kind"), "key", "value").unionByName(counts.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value")))
    values = materialize(values, "values")
    # the values of a block, then its texts: a task holds the values of one block and a batch of texts at a time
    known = seen.where(F.col("kind") != TOTAL).select("block", "kind", "key").join(values, ["kind", "key"])
    known = known.select("block", "kind", "key", "value", F.lit(None).cast("string").alias("text"))
    texts = placed.select("block", F.lit(TEXT).alias("kind"), F.col("doc_id").alias("key"), F.lit(None).cast("double").alias("value"), "text")
    rows = known.unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")
    log = lambda c: np.log10((c + 1) / (n + v + 1))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
    kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.float64()]

    def scored(ids: list, texts: list[str], values: Values) -> pa.RecordBatch:
        out = []
        for at, lengths, grams, per_doc, hashes in _chunks(texts):
            total = lambda size, x: np.bincount(np.repeat(np.arange(len(size)), size), x, minlength=len(size))
            model, counted = total(lengths, values.of(GRAM, grams)), values.of(WORD, hashes)
            base, hits = total(per_doc, log(counted)) + log(float(ends)), total(per_doc, (counted > 0).astype(float)) + (ends > 0)
            for k in range(len(lengths)):
                bits, i = -model[k] / math.log10(2) / int(lengths[k]), ids[at + k]
                out.append((i, is_held_out(i), int(per_doc[k]) + 1, int(hits[k]), n, float(base[k]), float(model[k]), int(lengths[k]), float(bits)))
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def score(batches):
        now = values = None
        for a, part in _runs(batches):
            if a != now:
                now, values = a, Values()
            kind = part.column("kind").to_numpy()
            here = int(np.searchsorted(kind, TEXT))
            if here:
                given = part.slice(0, here)
                values.add(kind[:here], given.column("key").to_numpy(zero_copy_only=False), given.column("value").to_numpy(zero_copy_only=False))
            for at in range(here, len(kind), 512):
                some = part.slice(at, 512)
                yield scored(some.column("key").to_pylist(), some.column("text").to_pylist(), values)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return rows.mapInArrow(score, schema)
