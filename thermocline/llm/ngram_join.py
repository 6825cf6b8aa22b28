"""Similarity join of documents on their sets of five-word shingles (Jaccard of 0.75 or more).

Every document's distinct shingles are hashed to 64 bits and ordered by hash, those that are
frequent in the corpus after all others, the most frequent last. In any order that all sets share, two
sets of this similarity have a common element among the first n - ceil(0.75 n) + 1 of each, so these
are the keys that bring candidates together, and unlike documents rarely meet in one. (Frequencies are
estimated on ORDER_ROWS rows: they decide the order, not what is compared or found.) Then set_join looks for links with a
count-vector R-tree and compares sets exactly. Documents with equal sets are one node. A
node's number is half of a 128-bit digest of its set; should two sets of the corpus
ever share a number, the hashes are drawn anew with another seed.

Defined results: a null or empty text, or one without words, has an empty set and links with
nothing; repeated rows link with each other; a null doc_id takes part as a text, its
component_id is the smallest known one, else null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import id_and_text, tidy
from thermocline.llm.components import components
from thermocline.llm.set_join import HOT, groups_of, links, point
from thermocline.llm.shingles import set_digest, shingle_set
from thermocline.session import materialize


TEXT_HASHES = ("text_1", "text_2")


def text_hashes(text: Column) -> dict[str, Column]:
    """Two hashes that tell the texts of one doc_id apart; a null text is empty."""
    return {c: F.xxhash64(F.lit(k), F.coalesce(text, F.lit(""))) for k, c in enumerate(TEXT_HASHES)}


#: Rows, about, on which frequencies of shingles are estimated, and shingles at most that count as frequent.
ORDER_ROWS = 40_000
FREQUENT = 20_000


def frequent_shingles(docs: DataFrame, seed: int, least: int = HOT) -> np.ndarray:
    """Hashes of shingles that about ``least`` texts or more hold, the most frequent last: at most FREQUENT. Equal texts
    count once."""
    every = max(1, docs.count() // ORDER_ROWS)
    few = max(8, least // every)

    @tidy
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                sets = [shingle_set(t, seed) for t in batch.column("text").slice(at, 2048).to_pylist()]
                key, n = np.unique(np.concatenate(sets), return_counts=True)
                keep = n > 1 if len(sets) > 1 else slice(None)  # a shingle that is frequent comes again within so many texts
                yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["key", "n"])

    code = text_hashes(F.col("text"))["text_1"]
    chosen = docs.where(F.pmod(code, F.lit(every)) == 0).withColumn("__code", code).dropDuplicates(["__code"]).select("text")
    counts = chosen.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= few)
    top = counts.orderBy(F.col("n").desc(), "key").limit(FREQUENT).collect()
    return np.array([r.key for r in reversed(top)], np.int64).view(np.uint64)


def prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first elements of a set: those of which two similar sets share one. ``frequent`` ones come last, in their order."""
    first = len(s) - (3 * len(s) + 3) // 4 + 1
    if len(frequent):
        by_hash = np.argsort(frequent)
        at = np.minimum(np.searchsorted(frequent[by_hash], s), len(frequent) - 1)
        rank = np.where(frequent[by_hash][at] == s, by_hash[at] + 1, 0)
        s = s[np.argsort(rank, kind="stable")]
    return s[:first].view(np.int64)


def _describe(docs: DataFrame, seed: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, two hashes of the text, n, node, check, counts (the node's point) and keys of every row; node and check
    are null for empty sets, counts and keys also where the task has had the set already."""

    @tidy
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, out = batch.slice(at, 512), []
                for t in part.column("text").to_pylist():
                    s = shingle_set(t, seed)
                    n = len(s)
                    node, check = set_digest(s) if n else (None, None)
                    if n and node not in seen:
                        seen.add(node)
                        own = s.view(np.int64)
                        out.append((n, node, check, point(own), prefix(s, frequent)))
                    else:
                        out.append((n, node, check, None, None))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                same = [part.column(c) for c in ("doc_id", *TEXT_HASHES)]
                yield pa.RecordBatch.from_arrays([*same, *columns], names=["doc_id", *TEXT_HASHES, "n", "node", "check", "counts", "keys"])

    described = docs.withColumns(text_hashes(F.col("text")))
    return described.mapInArrow(run, "doc_id long, text_1 long, text_2 long, n long, node long, check long, counts binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """(node, elements) of the nodes that ``wanted`` (doc_id, nodes) names for a document."""

    @tidy
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, nodes, elements = batch.slice(at, 256), [], []
                for text, names in zip(part.column("text").to_pylist(), part.column("nodes").to_pylist(), strict=True):
                    s = shingle_set(text, seed)
                    if len(s) and (node := set_digest(s)[0]) in names:
                        nodes.append(node)
                        elements.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(elements, pa.list_(pa.int64()))], names=["node", "elements"])

    rows = docs.join(wanted.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id"))).select("text", "nodes")
    return rows.mapInArrow(run, "node long, elements array<long>")


def _components(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """The described rows of ``docs``, and root and component_id (its least doc_id) of every node."""
    docs, seed = id_and_text(docs), 0
    while True:
        rows = materialize(_describe(docs, seed, frequent_shingles(docs, seed, hot)), "shingle-sets")
        nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min("check").alias("c"), F.max("check").alias("d"))
        nodes = materialize(nodes, "set-nodes")
        if nodes.where("c <> d").isEmpty():
            break
        seed += 1
    groups = groups_of(rows.select(F.explode("keys").alias("key"), "node"))
    active = groups.select("node").distinct()
    points = rows.where("counts is not null").join(active, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("counts").alias("counts"))
    points = materialize(points, "set-points")

    def fetch(wanted: DataFrame) -> DataFrame:
        homes = nodes.join(wanted, "node").groupBy(F.col("least_id").alias("doc_id")).agg(F.collect_set("node").alias("nodes"))  # the sets of one doc_id's rows
        return _sets(docs, materialize(homes, "sets-wanted"), seed).dropDuplicates(["node"])

    roots = materialize(components(materialize(links(groups, points, fetch, hot), "set-links")), "set-roots")
    placed = materialize(nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "sets-placed")
    ids = materialize(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "set-components")
    return rows, materialize(placed.join(ids, "root").select("node", "root", "component_id"), "set-results")


def ngram_components(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    rows, of_node = _components(docs, hot)
    own = rows.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("node is not null").join(of_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(own)


def keep_one_of_each(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id, and of its texts that with the least hashes.
    A null doc_id stays only where its component has no other. Rows are one document where doc_id and text are equal,
    but null ids without words are not. Components of one doc_id, or of null ids, each keep theirs."""
    rows, of_node = _components(docs, hot)
    least = rows.where("node is not null").join(of_node, "node").where("doc_id = component_id OR component_id IS NULL")
    least = least.groupBy("root").agg(F.min(F.struct("doc_id", *TEXT_HASHES)).alias("least")).select("least.*")
    # rows without words link with nothing
    wanted = least.unionByName(rows.where("node is null AND doc_id is not null").select("doc_id", *TEXT_HASHES))
    identity = lambda i: {"__id": F.coalesce(i, F.lit(0)), "__no_id": i.isNull()}
    names = ["__id", "__no_id", *[f"__{c}" for c in TEXT_HASHES]]
    wanted = wanted.select(*[c.alias(k) for k, c in identity(F.col("doc_id")).items()], *[F.col(c).alias(f"__{c}") for c in TEXT_HASHES]).distinct()
    unnamed = F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.where(~unnamed).withColumns(identity(F.col("doc_id").cast("long")) | {f"__{c}": h for c, h in text_hashes(F.col("text")).items()})
    kept = marked.join(wanted, names, "left_semi").dropDuplicates(names)
    return kept.select(*docs.columns).unionByName(docs.where(unnamed))
