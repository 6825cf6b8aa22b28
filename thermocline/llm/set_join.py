"""Join of similar sets (Jaccard similarity of 0.75 or more) down to connecting links.

Input are rows (key, node): two nodes with similar sets are known to share a key. Rows are
sorted by key over the cluster, a frequent key over several tasks, and each node is put
into the group of the smallest node that it shares a key with. A set is a point: its
elements are hashed into GROUPS groups, whose counts are the coordinates. The sum of the
coordinate minima of two points bounds the overlap of their sets, and that of a point and of
a box's upper corner bounds it for all points in the box: a count-vector R-tree (its boxes are
in the COARSE sums of neighbouring coordinates, its points in all). Points, not sets,
go through the groups; only the nodes that the bound leaves with a partner come back with their
sets, and a task compares its group's pairs exactly.

Each node is compared with its groups' first nodes, a row each, which connects copies of one
another by one link each. Pairs of other nodes of a group are then looked for in its R-tree,
unless they are connected already. A group of more than HOT nodes is dealt into blocks of one
size class each (boxes of the top level, in the coordinate of the sum); blocks of which one
holds a node that is not connected with the group's first, and whose sizes can match, are
searched in a task each. A search returns nodes, and a comparison returns links that connect what
is similar: never more than the group's rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.llm.common import tidy
from thermocline.llm.components import components
from thermocline.llm.shingles import enough
from thermocline.session import discard, materialize

GROUPS = 1024
#: Coordinates of the tree's boxes: sums of neighbouring groups.
COARSE = 64
#: A count that stands for itself and all larger ones.
MOST = 255
LEAF = 16
HOT = 512
#: Elements of the sets of one block.
ELEMENTS = 4_000_000


@tidy
def _runs(batches):
    """From rows sorted by (key, node): (key, first node of the key's run, node) for all further nodes,
    and, with a null node, the first and last run of the task."""
    key = first = last = None
    heads = []
    schema = pa.schema([("key", pa.int64()), ("center", pa.int64()), ("node", pa.int64())])
    for batch in batches:
        if not batch.num_rows:
            continue
        k, n = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        start = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        at = np.maximum.accumulate(np.where(start, np.arange(len(k)), -1))
        center = np.where(at < 0, first if first is not None else 0, n[np.maximum(at, 0)])
        fresh = np.concatenate([[last is None or start[0] or n[0] != last], (n[1:] != n[:-1]) | start[1:]])
        if not heads:
            heads.append((int(k[0]), int(center[0])))
        keep = fresh & (n != center)
        key, first, last = k[-1], center[-1], n[-1]
        yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(center[keep]), pa.array(n[keep])], schema=schema)
    if heads:
        heads.append((int(key), int(first)))
        yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in heads]), pa.array([h[1] for h in heads]), pa.array([None, None], pa.int64())], schema=schema)


def groups_of(keyed: DataFrame) -> DataFrame:
    """(center, node), center included, from (key, node): every two nodes that share a key share a center."""
    dealt = keyed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    runs = materialize(dealt.mapInArrow(_runs, "key long, center long, node long"), "key-runs")
    # keys that reach over tasks: at most one more than tasks; their later runs get the first run's center
    heads = runs.where("node is null").select("key", "center").distinct()
    over = heads.groupBy("key").agg(F.min("center").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "origin")
    over = materialize(over, "keys-over-tasks")
    rows = runs.where("node is not null").select("key", "center", "node").unionByName(heads.withColumn("node", F.col("center")))
    pairs = rows.join(F.broadcast(over), "key", "left").select(F.coalesce("origin", "center").alias("center"), "node").where("center <> node").distinct()
    pairs = materialize(pairs, "groups")
    discard(runs, over)
    return pairs.unionByName(pairs.select("center", F.col("center").alias("node")).distinct())


def point(elements: np.ndarray) -> bytes:
    """Count vector of a set, a byte for each group."""
    return np.minimum(np.bincount((elements >> 54) & (GROUPS - 1), minlength=GROUPS), MOST).astype(np.uint8).tobytes()


def _vectors(points) -> np.ndarray:
    return np.frombuffer(b"".join(points), np.uint8).reshape(-1, GROUPS)


def coarse(counts: np.ndarray) -> np.ndarray:
    """Coordinates of boxes; a count that may stand for more counts as 2**24, more than a set's share of a group."""
    wide = counts.astype(np.int32)
    wide[counts == MOST] = 1 << 24
    return wide.reshape(-1, COARSE, GROUPS // COARSE).sum(axis=2, dtype=np.int32)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least the overlap of sets with these count vectors."""
    least = np.minimum(a, b)
    return least.sum(axis=1, dtype=np.int64) + ((least == MOST).any(axis=1).astype(np.int64) << 40)


def _bounded_pairs(a: np.ndarray, b: np.ndarray, q: np.ndarray, at: np.ndarray, least: np.ndarray, bound, step: int) -> np.ndarray:
    """Whether 7 * bound(a[at], b[q]) >= least, worked out for ``step`` pairs at a time."""
    keep = np.empty(len(q), bool)
    for k in range(0, len(q), step):
        part = slice(k, k + step)
        keep[part] = 7 * bound(a[at[part]], b[q[part]]) >= least[part]
    return keep


def _box_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(axis=1, dtype=np.int64)


class CountTree:
    """R-tree over count vectors, bulk-loaded in order of the sets' sizes; LEAF children to a box."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order, self.counts, self.sizes = np.argsort(sizes, kind="stable"), counts, sizes
        corner, low, high = coarse(counts)[self.order], sizes[self.order], sizes[self.order]
        self.levels = []  # from the points up: upper corners, least and greatest size
        while True:
            self.levels.append((corner, low, high))
            if len(corner) <= LEAF:
                break
            at = np.arange(0, len(corner), LEAF)
            corner, low, high = np.maximum.reduceat(corner, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)

    def search(self, i: int) -> np.ndarray:
        """Positions of all sets whose overlap with the i-th may suffice."""
        return self.search_all(self.counts[i : i + 1], self.sizes[i : i + 1])[1]

    def search_all(self, counts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(q, i): the i-th set of the tree may overlap enough with the q-th of those given. All are taken
        down the tree together, a pair of set and box each."""
        wide, top = coarse(counts), len(self.levels) - 1
        boxes = len(self.levels[top][0])
        q, at = np.repeat(np.arange(len(sizes)), boxes), np.tile(np.arange(boxes), len(sizes))
        for level in range(top, -1, -1):
            corner, low, high = self.levels[level]
            keep = (4 * high[at] >= 3 * sizes[q]) & (3 * low[at] <= 4 * sizes[q])
            q, at = q[keep], at[keep]
            # similar: 7 * overlap >= 3 * (both sizes)
            keep = _bounded_pairs(corner, wide, q, at, 3 * (sizes[q] + low[at]), _box_bound, 4096)
            q, at = q[keep], at[keep]
            if level:
                at, q = (at[:, None] * LEAF + np.arange(LEAF)).ravel(), np.repeat(q, LEAF)
                keep = at < len(self.levels[level - 1][0])
                q, at = q[keep], at[keep]
        at = self.order[at]
        keep = _bounded_pairs(self.counts, counts, q, at, 3 * (sizes[q] + self.sizes[at]), overlap_bound, 512)
        return q[keep], at[keep]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    return enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b))


def candidates(sizes: np.ndarray, counts: np.ndarray, roots: np.ndarray, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(q, i): positions of pairs of different roots that the bound leaves, each pair once; of two sides, only pairs
    across them."""
    if side is not None and (side != side[0]).any():
        ask = side == side[0]
        tree = ~ask
    else:
        # of two roots, one is not the commonest: its nodes look for partners among all
        names, at, times = np.unique(roots, return_inverse=True, return_counts=True)
        ask, tree = at != times.argmax(), np.ones(len(sizes), bool)
    if not ask.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    asked, held = np.flatnonzero(ask), np.flatnonzero(tree)
    q, i = CountTree(counts[held], sizes[held]).search_all(counts[asked], sizes[asked])
    q, i = asked[q], held[i]
    keep = (roots[q] != roots[i]) & (~ask[i] | (i < q))
    return q[keep], i[keep]


def _group_candidates(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """The group's rows, each node once in order, and the pairs that the bound leaves. Rows are those of a group, or of
    one or two blocks of a large one (``mine``)."""
    rows = rows.take(pa.array(np.unique(rows.column("node").to_numpy(), return_index=True)[1]))
    n, root, mine = (rows.column(c).to_numpy() for c in ("n", "root", "mine"))
    return rows, *candidates(n, _vectors(rows.column("counts").to_pylist()), root, mine)


def _nodes_left(rows: pa.Table) -> pa.Table:
    """The rows of nodes that the bound leaves with a partner: at most those of the group."""
    rows, q, i = _group_candidates(rows)
    return rows.take(pa.array(np.unique(np.concatenate([q, i]))))


def _group_links(rows: pa.Table) -> pa.Table:
    """Links that connect all nodes of the group whose sets are similar: pairs are compared exactly and joined as they
    are found, so connected ones are not compared again and there are fewer links than nodes."""
    rows, q, i = _group_candidates(rows)
    node, elements = rows.column("node").to_numpy(), rows.column("elements").combine_chunks()
    own = [x.values.to_numpy() for x in elements]
    # a number for each set of connected nodes, at first those of one root
    group, out = np.unique(rows.column("root").to_numpy(), return_inverse=True)[1], []
    for a, b in zip(q.tolist(), i.tolist(), strict=True):
        if group[a] != group[b] and similar(own[a], own[b]):
            out.append((int(node[a]), int(node[b])))
            group[group == group[a]] = group[b]
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


@tidy
def _bounded(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            n, m = part.column("n").to_numpy(), part.column("m").to_numpy()
            most = overlap_bound(_vectors(part.column("counts").to_pylist()), _vectors(part.column("others").to_pylist()))
            keep = (7 * most >= 3 * (n + m)) & (4 * n >= 3 * m) & (4 * m >= 3 * n)
            yield part.select(["center", "node"]).filter(pa.array(keep))


@tidy
def _compared(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            pairs = zip(part.column("elements"), part.column("others"), strict=True)
            same = [similar(x.values.to_numpy(), y.values.to_numpy()) for x, y in pairs]
            yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))


def _compare(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar."""
    one, two = sets.select(F.col("node").alias("a"), "elements"), sets.select(F.col("node").alias("b"), F.col("elements").alias("others"))
    return materialize(pairs.join(one, "a").join(two, "b").select("a", "b", "elements", "others").mapInArrow(_compared, "a long, b long"), label)


def _rooted(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    own = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(own, node, "left").withColumn(root, F.coalesce(root, node))


GROUP = "center long, block long, block_b long"


def _to_search(members: DataFrame, points: DataFrame, hot: int) -> DataFrame:
    """Rows of groups that are searched in a task each: (center, block, block_b, node, n, counts, root, mine), from rows
    (center, node, n, root, main) and ``points``. A group of more than ``hot`` nodes or ELEMENTS elements is dealt into blocks."""
    used = ["node", "n", "root", "mine"]
    sizes = members.groupBy("center").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements"))
    members = materialize(members.join(sizes.withColumn("large", (F.col("size") > hot) | (F.col("elements") > ELEMENTS)), "center"), "group-sized")
    none, counted = F.lit(0).cast("long"), lambda rows: rows.join(points.select("node", "counts"), "node").select("center", "block", "block_b", "node", "n", "counts", "root", "mine")
    few = members.where("NOT large").select("center", none.alias("block"), none.alias("block_b"), "node", "n", "root", none.alias("mine"))
    many = members.where("large")
    if many.isEmpty():
        return counted(few)
    # a size class spans a factor of 4/3: similar sets are in the same or in neighbouring classes
    many = many.withColumn("class", F.floor(F.log("n") / F.log(F.lit(4 / 3)) + 1e-9))
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / hot), F.ceil(F.sum("n") / ELEMENTS))
    fill = materialize(many.groupBy("center", "class").agg(parts.alias("parts")), "group-classes")
    placed = many.join(fill, ["center", "class"]).withColumn("mine", F.col("class") * F.lit(1 << 32) + F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = materialize(placed.select("center", "class", "mine", "node", "n", "root", "main"), "group-placed")
    blocks = materialize(placed.groupBy("center", "class", "mine").agg(F.max((F.col("root") != F.col("main")).cast("int")).alias("open")), "group-blocks")
    one, two = blocks.withColumnRenamed("mine", "block"), blocks.toDF("center", "class_b", "block_b", "open_b")
    met = one.join(two, "center").where("block <= block_b AND class_b - class <= 1 AND (open = 1 OR open_b = 1)")
    ends = materialize(met.select("center", "block", "block_b", F.explode(F.array_distinct(F.array("block", "block_b"))).alias("mine")), "group-block-pairs")
    return counted(few.unionByName(placed.join(ends, ["center", "mine"]).select("center", "block", "block_b", *used)))


def links(groups: DataFrame, points: DataFrame, fetch: Callable[[DataFrame], DataFrame], hot: int = HOT) -> DataFrame:
    """(a, b): links that connect all nodes with similar sets, from ``groups`` (center, node) and ``points``
    (node, n, counts); ``fetch`` gives (node, elements: distinct longs) for a table of nodes."""
    other = points.select(F.col("node").alias("center"), F.col("n").alias("m"), F.col("counts").alias("others"))
    stars = groups.where("center <> node").join(points, "node").join(other, "center").select("center", "node", "n", "m", "counts", "others")
    stars = materialize(stars.mapInArrow(_bounded, "center long, node long"), "stars")
    sets = materialize(fetch(stars.select("node").union(stars.select("center")).distinct()), "sets")
    first = materialize(stars.groupBy("node").agg(F.min("center").alias("center")), "stars-first")
    found = _compare(first.select(F.col("center").alias("a"), F.col("node").alias("b")), sets, "links-first")
    roots = materialize(components(found), "roots-first")
    rest = stars.join(first.withColumnRenamed("center", "least"), "node").where("center <> least").select("node", "center")
    rest = _rooted(_rooted(rest, roots, "node", "root"), roots, "center", "main").where("root <> main")
    found = materialize(found.unionByName(_compare(rest.select(F.col("center").alias("a"), F.col("node").alias("b")), sets, "links-rest")), "links-stars")
    roots = materialize(components(found), "roots-stars")
    sizes = groups.groupBy("center").agg(F.count(F.lit(1)).alias("size")).where("size > 2")
    # points are a hundred times as wide as a member's other columns: they come to it where it is searched, not before
    members = groups.join(materialize(sizes, "group-sizes"), "center").join(points.select("node", "n"), "node")
    members = materialize(_rooted(_rooted(members, roots, "node", "root"), roots, "center", "main"), "group-members")
    mixed = materialize(members.where("root <> main").select("center").distinct(), "groups-mixed")
    searched = _to_search(members.drop("size").join(mixed, "center", "left_semi"), points, hot)
    keys, point_row = ["center", "block", "block_b"], "node long, n long, counts binary, root long, mine long"
    left = materialize(searched.groupBy(*keys).applyInArrow(_nodes_left, f"{GROUP}, {point_row}"), "nodes-left")
    if left.isEmpty():
        return found
    new = left.select("node").distinct().join(sets, "node", "left_anti")
    sets = materialize(sets.unionByName(fetch(new)), "sets-all")
    return found.unionByName(left.join(sets, "node").groupBy(*keys).applyInArrow(_group_links, "a long, b long"))
