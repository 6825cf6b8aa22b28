"""Hard negatives by inner product, with a cover tree over norm-augmented candidates.

An anchor's positives are its best-scoring rows of the same label; a positive with score p
opens the window of negative scores from LOW to HIGH hundredths of p, from which the best
rows of other labels are taken. Both are searches for the k best scores inside a window, made
by the same search over cover trees.

Candidates are dealt into blocks of about BLOCK rows (positives: blocks of one label), anchors
into batches of about BATCH; a task holds one block and one batch, whatever a label's share of
the rows. The block's vectors get one more coordinate, sqrt(M * M - |x| * |x|) with M the largest
norm in the block: all then lie on a sphere and an inner product with an anchor is M * |anchor|
times the cosine of an angle. A node of the tree covers its points within the chord r of its
centre, at most 2**level and measured exactly when the tree is built, so every score below it
lies between the cosines of the centre's angle plus and minus that of r. The descent takes the
node with the highest bound first, for all anchors of the batch that it may still serve; it
skips nodes that lie outside an anchor's windows or under what the anchor has found, and
verifies the points of leaves by exact integer products. Each block gives at most k rows for an
anchor's window; the k best of all blocks are chosen by a ranked window with map-side limits.

Where vectors have no cluster structure the bounds exclude little, and the work is that of all
anchors with all rows, in blocks.

Defined results: rows with a null label, a null vector or a null or non-finite component take
no part, nor do rows whose integer vector has a squared norm of 2**62 or more (their scores do not
fit into a long). Vectors of different lengths do not meet; empty ones score 0. A null id is no
anchor, keeps its label and comes last among ties. Repeated rows are rows of their own: an anchor's
copy can be its positive, and a repeated anchor returns its rows again. Anchors without
positives, and windows without rows, return nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermocline.session import materialize

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: Hundredths of the positive's score.
LOW, HIGH = 50, 95
BLOCK, BATCH = 2048, 1024
#: Points of a leaf.
LEAF = 32
#: Squared norms from here on may give scores beyond a long.
NORM_LIMIT = 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class CoverTree:
    """Cover tree over the rows of an integer matrix, which keep their positions.

    ``nodes`` holds, for each inner node, its children: position of the centre, covering chord, child's
    own node (-1: none), and whether the centre is new (not the node's own, which its parent has
    verified). A leaf's points are children of chord 0 without a node.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        x = points.astype(float)
        squares = (x * x).sum(axis=1)
        self.norm = float(np.sqrt(squares.max(initial=0.0)))
        lift = np.sqrt(np.maximum(0.0, self.norm**2 - squares))
        self._inner = x @ x.T + np.outer(lift, lift)
        self.slack = 1e-6 * self.norm
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        members = np.arange(len(points))
        self.root = self._build(members, 0, self._chords(0, members), new=True)
        del self._inner

    def _chords(self, i: int, members: np.ndarray) -> np.ndarray:
        """Distance of the augmented points from the i-th."""
        return np.sqrt(np.maximum(0.0, 2.0 * (self.norm**2 - self._inner[i, members])))

    def _build(self, members: np.ndarray, centre: int, far: np.ndarray, new: bool = False) -> int:
        """Node of ``members``, which lie at the distances ``far`` from their centre; its number."""
        radius = far.max()
        if len(members) <= self.leaf or radius <= self.slack:
            children = [(int(i), 0.0, -1, new or i != centre) for i in members]
        else:
            cover = 2.0 ** (np.ceil(np.log2(radius)) - 1)  # the next level's covering radius
            near, owner, centres = far.copy(), np.zeros(len(members), np.int64), [centre]
            while near.max() > cover:  # farthest first: centres are further apart than they cover
                centres.append(int(members[near.argmax()]))
                d = self._chords(centres[-1], members)
                closer = d < near
                near[closer], owner[closer] = d[closer], len(centres) - 1
            children, order = [], np.argsort(owner, kind="stable")
            for c, at in zip(centres, np.split(order, np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1]), strict=True):
                own = members[at]
                node = self._build(own, c, near[at]) if len(own) > 1 else -1
                children.append((c, float(near[at].max()), node, new or c != centre))
        columns = zip(*children, strict=True)
        self.nodes.append(tuple(np.array(x, t) for x, t in zip(columns, (np.int64, float, np.int64, bool), strict=True)))
        return len(self.nodes) - 1

    def products(self, anchors: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products; in doubles where every sum stays below 2**53."""
        x = self.points[at]
        if float(np.sqrt((anchors.astype(float) ** 2).sum(axis=1)).max(initial=0.0)) * self.norm < 2.0**52:
            return (anchors.astype(float) @ x.astype(float).T).astype(np.int64)
        return anchors @ x.T

    def bounds(self, norms: np.ndarray, scores: np.ndarray, chords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score of anchors of these norms below centres that score so and cover so far."""
        size = norms[:, None] * self.norm
        angle = np.arccos(np.clip(scores / np.maximum(size, 1e-300), -1.0, 1.0))
        spread = 2.0 * np.arcsin(np.clip((chords + self.slack) / max(2.0 * self.norm, 1e-300), 0.0, 1.0))[None, :]
        slack = 1e-6 * size + 1.0
        return size * np.cos(np.minimum(np.pi, angle + spread)) - slack, size * np.cos(np.maximum(0.0, angle - spread)) + slack


def search(tree: CoverTree, vectors: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, banned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, point, score): the k highest scores of each window, ties by the points' position.

    A window is an anchor (``owner``, a row of ``vectors``) with least and greatest scores; ``banned(windows,
    points)`` tells which pairs do not count.
    """
    best = np.full((len(low), k), LEAST, np.int64)  # of each window, the highest scores so far
    least = lambda w: np.maximum(best[w].min(axis=1), low[w])
    norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    every = np.arange(len(low))
    heap = [(0.0, 0, tree.root, every, np.full(len(low), -np.inf), np.full(len(low), np.inf))]
    pushed = 1
    while heap:
        _, _, node, windows, under, over = heapq.heappop(heap)
        open_ = (over >= least(windows)) & (under <= high[windows])
        windows = windows[open_]
        if not len(windows):
            continue
        centres, chords, below, new = tree.nodes[node]
        anchors, at = np.unique(owner[windows], return_inverse=True)
        scores = tree.products(vectors[anchors], centres)
        mine = scores[at]
        fits = new[None, :] & (mine <= high[windows][:, None]) & (mine >= least(windows)[:, None])
        w, c = np.nonzero(fits)
        keep = ~banned(windows[w], centres[c])
        w, c = w[keep], c[keep]
        if len(w):
            found.append((windows[w], centres[c], mine[w, c]))
            rows = np.unique(w)
            fits[:] = False
            fits[w, c] = True
            held = np.concatenate([best[windows[rows]], np.where(fits[rows], mine[rows], LEAST)], axis=1)
            best[windows[rows]] = ~np.partition(~held, k - 1, axis=1)[:, :k]  # ~x falls as x rises, also for the least long
        inner = np.flatnonzero(below >= 0)
        if len(inner):
            lows, highs = tree.bounds(norms[anchors], scores[:, inner], chords[inner])
            wanted, most = least(windows), high[windows]
            for j, child in enumerate(inner):
                lo, hi = lows[at, j], highs[at, j]
                serves = (hi >= wanted) & (lo <= most)
                if serves.any():
                    heapq.heappush(heap, (-float(hi[serves].max()), pushed, int(below[child]), windows[serves], lo[serves], hi[serves]))
                    pushed += 1
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    w, p, s = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((p, ~s, w))
    w, p, s = w[order], p[order], s[order]
    rank = np.arange(len(w)) - np.maximum.accumulate(np.where(np.r_[True, w[1:] != w[:-1]], np.arange(len(w)), 0))
    keep = rank < k
    return w[keep], p[keep], s[keep]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.int64)


def _split(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(anchors, candidates in order of vec_id, nulls last)."""
    asked = rows.filter(rows["asked"])
    held = rows.filter(pa.compute.invert(rows["asked"]))
    return asked, held.sort_by([("vec_id", "ascending"), ("row", "ascending")])


def _positives(rows: pa.Table) -> pa.Table:
    anchors, held = _split(rows)
    out = {"anchor": [], "vec_id": [], "row": [], "score": []}
    if anchors.num_rows and held.num_rows:
        mine, theirs = anchors["row"].to_numpy(), held["row"].to_numpy()
        n = anchors.num_rows
        w, p, s = search(
            CoverTree(_matrix(held["v"])), _matrix(anchors["v"]), np.arange(n), np.full(n, LEAST), np.full(n, MOST), POSITIVES, lambda w, p: mine[w] == theirs[p]
        )
        out = {"anchor": mine[w], "vec_id": held["vec_id"].take(pa.array(p)), "row": theirs[p], "score": s}
    return pa.table(out, schema=pa.schema([("anchor", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())]))


def _negatives(rows: pa.Table) -> pa.Table:
    anchors, held = _split(rows)
    out = {"anchor": [], "positive_score": [], "vec_id": [], "row": [], "score": []}
    if anchors.num_rows and held.num_rows:
        scores = [sorted(set(x)) for x in anchors["scores"].to_pylist()]
        owner = np.repeat(np.arange(len(scores)), [len(x) for x in scores])
        positive = np.array([s for own in scores for s in own], np.int64)
        low = np.array([-(-LOW * int(s) // 100) for s in positive], np.int64)
        high = np.array([HIGH * int(s) // 100 for s in positive], np.int64)
        asked, theirs = anchors["label"].to_numpy(), held["label"].to_numpy()
        w, p, s = search(CoverTree(_matrix(held["v"])), _matrix(anchors["v"]), owner, low, high, NEGATIVES, lambda w, p: asked[owner[w]] == theirs[p])
        out = {"anchor": anchors["row"].to_numpy()[owner[w]], "positive_score": positive[w], "vec_id": held["vec_id"].take(pa.array(p)), "row": held["row"].to_numpy()[p], "score": s}
    names = ["anchor", "positive_score", "vec_id", "row", "score"]
    return pa.table(out, schema=pa.schema([(x, pa.int64()) for x in names]))


def integer_vector(vector: str = "embedding") -> Column:
    return F.transform(vector, lambda x: F.floor(x * SCALE).cast("long"))


def usable_rows(vectors: DataFrame) -> DataFrame:
    """row, vec_id, label, v (integer vector) and dim of the rows that take part."""
    plain = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x * SCALE).cast("double"), F.lit(2.0)))
    # components are converted only where all are known to be finite and to fit
    v = F.when(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)), F.col("embedding"))
    rows = plain.withColumn("embedding", v).where("embedding IS NOT NULL")
    small = ~F.exists("embedding", lambda x: F.abs(x) * SCALE >= 2.0**31)
    rows = rows.where(small & (F.when(small, squares) < NORM_LIMIT))
    return rows.select("row", "vec_id", "label", F.when(small, integer_vector()).alias("v"), F.size("embedding").alias("dim"))


def _dealt(key: list[str], held: DataFrame, asked: DataFrame, block: int, batch: int) -> DataFrame:
    """Candidates and anchors with equal ``key``, once for each pair of a block and a batch."""
    sizes = held.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    counts = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / batch).cast("int").alias("batches"))
    plan = materialize(sizes.join(counts, key), "negatives-blocks")
    placed = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = held.join(plan, key).withColumn("part", placed("part", "parts")).withColumn("batch", every("batches"))
    asked = asked.join(plan, key).withColumn("batch", placed("batch", "batches")).withColumn("part", every("parts"))
    same = [c for c in (*key, "part", "batch", "row", "vec_id", "label", "v")]
    same = list(dict.fromkeys(same))
    held = held.select(*same, F.lit(None).cast("array<long>").alias("scores"), F.lit(False).alias("asked"))
    return held.unionByName(asked.select(*same, "scores", F.lit(True).alias("asked")))


def _first(found: DataFrame, group: list[str], n: int) -> DataFrame:
    """The ``n`` highest scores of each group, ties by the smaller vec_id (a null one last)."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine_hard_negatives(vectors: DataFrame, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for ``vectors`` (vec_id,
    embedding, label); labels are taken as they are."""
    rows = materialize(usable_rows(vectors), "negatives-rows")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    dealt = _dealt(["dim", "label"], rows, anchors.withColumn("scores", F.lit(None).cast("array<long>")), block, batch)
    found = dealt.groupBy("dim", "label", "part", "batch").applyInArrow(_positives, "anchor long, vec_id long, row long, score long")
    positives = materialize(_first(found, ["anchor"], POSITIVES).drop("rank"), "negatives-positives")
    scores = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("scores"))  # at most POSITIVES
    dealt = _dealt(["dim"], rows, anchors.join(scores, "row"), block, batch)
    found = dealt.groupBy("dim", "part", "batch").applyInArrow(_negatives, "anchor long, positive_score long, vec_id long, row long, score long")
    best = materialize(_first(found, ["anchor", "positive_score"], NEGATIVES), "negatives-found")
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = positives.join(ids, "anchor").select("anchor", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    chosen = best.select("anchor", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(chosen, ["anchor", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """The query's labels: (label + 1) % 10 where vec_id is divisible by 7."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
