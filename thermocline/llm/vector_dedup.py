"""Near-duplicate vectors by an exact metric range join.

On unit vectors, cosine >= c is Euclidean distance <= r = sqrt(2 - 2c). Pivots partition the
vectors: each goes to the cell of its nearest pivot p. By the triangle inequality, a vector
can only have a partner in another cell, of pivot q, if its distance to q is at most the
cell's radius plus r, and at most its distance to p plus 2r; only then is it copied to that
cell's boundary. Cells are dealt into blocks of about BLOCK vectors, and every pair of blocks
that share boundary vectors is joined on its own: a task holds two blocks, whatever the
size of a cell, and gives link counts and a spanning set of links, never all pairs. Equal
vectors are joined as one with their number. Where vectors have no cluster structure, the
bounds exclude little and the work grows with the square of the distinct vectors: that is
the cost of an exact answer there.

Defined results: a vector that is null, zero, or holds null or non-finite components links
with nothing, and so do vectors of different lengths; rows with equal vectors link with each
other, repeated rows too; a null vec_id counts as a vector, its own component_id is the
smallest known one it reaches, else null, and it is not kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import attach_group
from thermocline.llm.components import components
from thermocline.session import materialize

COSINE = 0.9
BLOCK = 4096
#: Pivots: one a block up to PIVOTS, beyond it the square root of the vectors up to MAX_PIVOTS, which bounds what the
#: driver and each task hold of them. They are chosen among CHOICES vectors of least hash for each up to PIVOTS, or four.
PIVOTS, MAX_PIVOTS, CHOICES = 128, 4096, 16
SLACK = 1e-6


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, float) for v in vectors], float)
    x /= abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * x @ pivots.T))


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the vectors, each the farthest from those before it."""
    chosen, near = [0], _distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < min(n, len(vectors)) and near.max() > SLACK:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def _assigned(nodes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """node, times, embedding, cell and own: the distance to the cell's pivot."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                d = _distances(_unit(batch.column("embedding").to_pylist()), pivots)
                cell = d.argmin(axis=1)
                own = d[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(own)], names=[*batch.schema.names, "cell", "own"])

    kind = dict(nodes.dtypes)["embedding"]
    return nodes.select("node", "times", "embedding").mapInArrow(run, f"node long, times long, embedding {kind}, cell int, own double")


def join_blocks(left: pd.DataFrame, right: pd.DataFrame | None, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of each vector of ``left`` and of ``right`` (within ``left`` without it) to the other side,
    counted with the numbers of equal vectors, and links that connect all that are connected."""
    a, ta = _unit(left["embedding"].tolist()), left["times"].to_numpy()
    b, tb = (a, ta) if right is None else (_unit(right["embedding"].tolist()), right["times"].to_numpy())
    na, nb = left["node"].tolist(), (left if right is None else right)["node"].tolist()
    shift = 0 if right is None else len(a)
    group, links = np.arange(len(a) + (0 if right is None else len(b))), []  # group: a number for each set connected so far
    count_a, count_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for at in range(0, len(a), 512):
        near = a[at : at + 512] @ b.T >= cosine
        if right is None:
            k = np.arange(len(near))
            near[k, at + k] = False
        count_a[at : at + 512] += near @ tb
        if right is not None:
            count_b += near.T @ ta[at : at + 512]
        for i in np.flatnonzero(near.any(axis=1)):
            mates = np.flatnonzero(near[i])
            while len(mates := mates[group[shift + mates] != group[at + i]]):
                group[group == group[shift + mates[0]]] = group[at + i]
                links.append((na[at + i], nb[mates[0]]))
    return count_a, count_b, links


def _block_pairs(cells: DataFrame, pivots: np.ndarray, radius: list[float], parts: list[int], r: float) -> DataFrame:
    """Rows of ``cells`` once for each pair of blocks (low, high) that they take part in; mine is the row's block."""
    first = np.concatenate([[0], np.cumsum(parts)])
    rad, parts_of = np.array(radius), np.array(parts)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if not part.num_rows:
                    continue
                cell = part.column("cell").to_numpy()
                reach = _distances(_unit(part.column("embedding").to_pylist()), pivots)
                node, own = part.column("node").to_numpy(), part.column("own").to_numpy()
                mine = first[cell] + (node * 2654435761 >> 16) % parts_of[cell]
                meets = (reach <= rad + r + SLACK) & (reach <= own[:, None] + 2 * r + SLACK) & (parts_of > 0)
                meets[np.arange(len(cell)), cell] = True
                row, cells_met = np.nonzero(meets)
                times = parts_of[cells_met]
                row = np.repeat(row, times)
                other = np.repeat(first[cells_met], times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                cut = part.take(pa.array(row))
                low, high = np.minimum(mine[row], other), np.maximum(mine[row], other)
                yield pa.RecordBatch.from_arrays(
                    [cut.column("node"), cut.column("times"), cut.column("embedding"), pa.array(low), pa.array(high), pa.array(mine[row] == low)],
                    names=["node", "times", "embedding", "low", "high", "is_low"],
                )

    kind = dict(cells.dtypes)["embedding"]
    return cells.mapInArrow(run, f"node long, times long, embedding {kind}, low long, high long, is_low boolean")


def linked(nodes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(node, to, links) from rows (node, times, embedding) of one length: parts of each node's number of
    links, and, where ``to`` is not null, links that connect all nodes that are connected."""
    r = math.sqrt(2.0 - 2.0 * cosine)
    n = nodes.count()
    want = max(1, min(max(PIVOTS, math.isqrt(n)), MAX_PIVOTS, -(-n // block)))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(max(CHOICES * min(want, PIVOTS), 4 * want)).select("embedding").collect()
    if not sample:
        return nodes.sparkSession.createDataFrame([], "node long, to long, links long")
    pivots = choose_pivots(_unit([x.embedding for x in sample]), want)
    cells = materialize(_assigned(nodes, pivots), "vector-cells")
    stats = {s.cell: s for s in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("radius")).collect()}
    size = [stats[k].n if k in stats else 0 for k in range(len(pivots))]
    radius = [stats[k].radius if k in stats else -9.0 for k in range(len(pivots))]
    pairs = _block_pairs(cells, pivots, radius, [-(-s // block) for s in size], r)

    def run(key, rows):
        if key[0] == key[1]:
            counts, _, links = join_blocks(rows, None, cosine)
            counted = zip(rows["node"], counts, strict=True)
        else:
            left, right = rows[rows["is_low"]], rows[~rows["is_low"]]
            if not len(left) or not len(right):
                return pd.DataFrame({"node": [], "to": [], "links": []})
            a, b, links = join_blocks(left, right, cosine)
            counted = zip([*left["node"], *right["node"]], [*a, *b], strict=True)
        out = [(x, None, c) for x, c in counted if c] + [(x, y, 0) for x, y in links]
        return pd.DataFrame(out, columns=["node", "to", "links"]).astype({"node": "Int64", "to": "Int64", "links": "Int64"})

    return pairs.groupBy("low", "high").applyInPandas(run, "node long, to long, links long")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (vec_id, embedding)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    equal = attach_group(rows.where("usable").select("vec_id", "embedding", "row"), ["embedding"], {"node": F.min("row"), "times": F.count(F.lit(1)), "least_id": F.min("vec_id")})
    equal = materialize(equal, "vectors-equal")
    nodes = materialize(equal.where("row = node").select("node", "times", "least_id", "embedding"), "vector-nodes")
    found = None
    for (size,) in nodes.select(F.size("embedding")).distinct().collect():  # one length, or a few
        part = linked(nodes.where(F.size("embedding") == size), cosine, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = materialize(found, "vector-links")
    roots = materialize(components(found.where("to is not null").select("node", "to")), "vector-roots")
    placed = materialize(nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "vectors-placed")
    ids = materialize(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "vector-components")
    counts = materialize(found.groupBy("node").agg(F.sum("links").alias("links")), "vector-counts")
    of_node = materialize(placed.join(ids, "root").join(counts, "node", "left").select("node", "component_id", F.coalesce("links", F.lit(0)).alias("links")), "vector-results")
    out = equal.select("vec_id", "node", "times").join(of_node, "node").select("vec_id", (F.col("links") + F.col("times") - 1).alias("n_links"), "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
