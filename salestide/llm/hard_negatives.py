"""Hard negatives by inner product, with cover trees over norm-augmented candidates.

1. *Forest.* Candidates are dealt to chunks: a label with many rows has chunks of its own, small labels share
   some. Each chunk is one cover tree, built in one task and stored.
2. *Augmentation.* A candidate gets one more component that brings all of a tree to the same norm, so
   that near in distance means alike in inner product with any anchor, whose extra component is 0.
   The last component of a point never meets the anchor; it only makes the radii say what they should.
3. *Trees.* A node has a centre among its points and the radius that covers them; its children cover
   them with radii smaller by a step. Points that no ball of the next level gathers stay at the node.
   By Cauchy and Schwarz the products of an anchor with a node's points lie within
   ``|anchor| * radius`` of the centre's.
4. *Descent.* An anchor takes a tree's nodes in the order of their upper bounds. Nodes outside its
   windows are skipped, points of the others are multiplied out exactly, and it stops at the first node
   whose bound is below what every window has already.
5. *Two passes.* The first finds each anchor's positives in trees that hold its label. They give the
   windows of the second, which goes through all trees. Each tree returns a few rows for a window, which
   are then merged.

Anchors meet trees in blocks of both; nothing is broadcast and no task holds all of either.

Defined results: rows with a NULL id, label or vector, or with a NULL or non-finite component, take
no part; components beyond 2**26 count as that; shorter vectors are filled up with zeros, and
a vector without components has the product 0 with all; rows that repeat id, label and vector count once;
other rows of the anchor's id are neither its positives nor its negatives; an anchor without positives,
or a positive with an empty window, has no rows; other columns are ignored; no vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salestide.llm.rows import named
from salestide.session import stored

#: Rows of a tree, and anchors that meet it in one task, about.
TREE, ANCHORS = 8192, 2048
#: A node of at most so many points has no children.
LEAF = 24
#: The radius of a level over that of the next one.
STEP = 1.3
#: Points that an anchor multiplies out between two looks at its windows.
BATCH = 512
LARGEST = 1 << 26


@dataclass(frozen=True)
class Windows:
    """A negative's product, as a percentage of the positive's, and how many of both."""

    least: int = 50
    most: int = 95
    positives: int = 5
    negatives: int = 3


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Components scaled and rounded down."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


class CoverTree:
    """Points in the order of the tree, and its nodes: centre, radius and own points."""

    def __init__(self, points: np.ndarray):
        norms = (points * points).sum(axis=1)
        extra = np.sqrt(np.maximum(0, norms.max() - norms))
        self.points = np.c_[points, extra]
        self.order: list[np.ndarray] = []
        self.centres: list[int] = []
        self.radii: list[float] = []
        self.counts: list[int] = []
        self._grow(np.arange(len(points)))

    def _distances(self, centre: int, rows: np.ndarray) -> np.ndarray:
        apart = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))

    def _node(self, centre: int, radius: float, own: np.ndarray) -> None:
        self.centres.append(centre)
        self.radii.append(radius)
        self.counts.append(len(own))
        self.order.append(own)

    def _grow(self, rows: np.ndarray) -> None:
        waiting = [(rows, int(rows[0]), self._distances(int(rows[0]), rows))]
        while waiting:
            rows, centre, apart = waiting.pop()
            radius = float(apart.max())
            if len(rows) <= LEAF or radius == 0:
                self._node(centre, radius, rows)
                continue
            children, rest = self._covered(rows, centre, apart, radius / STEP)
            self._node(centre, radius, rest)
            waiting += children

    def _covered(self, rows: np.ndarray, centre: int, apart: np.ndarray, reach: float) -> tuple[list, np.ndarray]:
        """Balls of the next level, each with its points, and the points that stay behind.

        Balls are taken while they gather points: where every point is about as far from every
        other, balls would be single points, and those are as well looked at one by one.
        """
        children, single, left, far = [], [], rows, apart
        lone = 0
        while len(left):
            near = far <= reach
            if near.sum() > LEAF // 4:
                children.append((left[near], centre, far[near]))
                lone = 0
            else:
                single.append(left[near])
                lone += 1
            left = left[~near]
            if not len(left) or lone > 8:
                break
            centre = int(left[0])
            far = self._distances(centre, left)
        return children, np.concatenate([*single, left])


@dataclass
class Tree:
    """A stored tree: ids, labels and whole-number points in order, and the nodes' arrays."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    starts: np.ndarray


def built(ids: np.ndarray, labels: np.ndarray, vectors: list) -> Tree:
    """The tree of a chunk; rows that are the same in all count once."""
    width = max((len(v) for v in vectors), default=0)
    points = np.zeros((len(vectors), max(1, width)), np.int64)
    for k, vector in enumerate(vectors):
        points[k, : len(vector)] = vector
    order = np.lexsort((labels, ids))
    ids, labels, points = ids[order], labels[order], points[order]
    again = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1])
    if again.any():
        _, first = np.unique(np.c_[ids, labels, points], axis=0, return_index=True)
        ids, labels, points = ids[first], labels[first], points[first]
    tree = CoverTree(points.astype(np.float64))
    order = np.concatenate(tree.order)
    # Distances are rounded: the radii are taken a little larger than they come out.
    radii = np.array(tree.radii) * (1 + 1e-9) + 1e-6
    starts = np.r_[0, np.cumsum(tree.counts)]
    return Tree(ids[order], labels[order], points[order], points[tree.centres], radii, starts)


def products(points: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact products; by floating point where that is exact."""
    if points.dtype == np.int64:
        return points @ anchor.astype(np.int64)
    return (points @ anchor).astype(np.int64)


class Search:
    """Descents of a tree for anchors, one after the other."""

    def __init__(self, tree: Tree, anchors: np.ndarray):
        self.tree = tree
        width = max(tree.points.shape[1], anchors.shape[1])
        wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
        points, anchors, centres = wide(tree.points), wide(anchors), wide(tree.centres)
        top = max(1, int(np.abs(points).max(initial=0))), max(1, int(np.abs(anchors).max(initial=0)))
        kind = np.float64 if top[0] * top[1] * width < 2**53 else np.int64
        self.points, self.anchors = points.astype(kind), anchors.astype(kind)
        at = anchors.astype(np.float64) @ centres.T.astype(np.float64)
        room = np.linalg.norm(anchors.astype(np.float64), axis=1)[:, None] * tree.radii
        room += 1e-9 * np.abs(at) + 1
        self.upper, self.lower = at + room, at - room
        self.filled = np.diff(tree.starts) > 0

    def best(self, k: int, allowed: np.ndarray, windows: list[tuple[int, int]], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the places and products of the first ``count`` allowed points in it.

        ``windows`` have the least and the largest product, both included.
        """
        low, high = (np.array(side, np.float64) for side in zip(*windows))
        upper, lower = self.upper[k], self.lower[k]
        nodes = np.flatnonzero(self.filled & (upper >= low.min()) & (lower <= high.max()))
        nodes = nodes[np.argsort(-upper[nodes], kind="stable")]
        starts, sizes = self.tree.starts[nodes], np.diff(self.tree.starts)[nodes]
        ends = np.cumsum(sizes)
        # What a product must reach in each window to be among the first.
        least = low.copy()
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < len(nodes) and upper[nodes[at]] >= least.min():
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH, "right")))
            part = nodes[at:to]
            inside = (upper[part][:, None] >= least) & (lower[part][:, None] <= high)
            held = inside.any(axis=1)
            begin, size = starts[at:to][held], sizes[at:to][held]
            rows = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            rows = rows[allowed[rows]]
            found = products(self.points[rows], self.anchors[k])
            kept = (found >= least.min()) & (found <= high.max())
            places, scores = np.r_[places, rows[kept]], np.r_[scores, found[kept]]
            for j in range(len(windows)):
                own = scores[(scores <= high[j]) & (scores >= least[j])]
                if len(own) >= count:
                    least[j] = np.partition(own, len(own) - count)[len(own) - count]
            at = to
        result = []
        for j in range(len(windows)):
            own = np.flatnonzero((scores <= high[j]) & (scores >= least[j]))
            order = np.lexsort((self.tree.ids[places[own]], -scores[own]))[:count]
            result.append((places[own[order]], scores[own[order]]))
        return result


def _number(kind: type, column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(kind)


def _build(table: pa.Table) -> pa.Table:
    tree = built(
        _number(np.int64, table.column("id")), _number(np.int64, table.column("label")), table.column("vector").to_pylist()
    )
    arrays = [tree.ids, tree.labels, tree.points, tree.centres, tree.radii, tree.starts.astype(np.int64)]
    columns = [pa.array([table.column("tree")[0].as_py()], pa.int64()), pa.array([tree.points.shape[1]], pa.int64())]
    columns += [pa.array([np.ascontiguousarray(one).tobytes()], pa.binary()) for one in arrays]
    columns.append(pa.array([np.unique(tree.labels)], pa.list_(pa.int64())))
    return pa.Table.from_arrays(columns, ["tree", "width", *PARTS, "held"])


PARTS = ["ids", "labels", "points", "centres", "radii", "starts"]
TREES = "tree long, width long, " + ", ".join(f"{part} binary" for part in PARTS) + ", held array<long>"


def _opened(table: pa.Table) -> Tree:
    row = table.slice(0, 1).to_pylist()[0]
    kinds = dict.fromkeys(PARTS, np.int64) | {"radii": np.float64}
    parts = {part: np.frombuffer(row[part], kinds[part]) for part in PARTS}
    for part in ("points", "centres"):
        parts[part] = parts[part].reshape(-1, row["width"])
    return Tree(**parts)


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.Table.from_arrays([pa.array(column, pa.int64()) for column in columns], names)


def _anchors(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vectors = table.column("vector").to_pylist()
    points = np.zeros((len(vectors), max(1, max(map(len, vectors)))), np.int64)
    for k, vector in enumerate(vectors):
        points[k, : len(vector)] = vector
    keys, ids, labels = (_number(np.int64, table.column(name)) for name in ("key", "id", "label"))
    return keys, ids, labels, points


def _positives(count: int):
    def positives(anchors: pa.Table, trees: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if anchors.num_rows and trees.num_rows:
            tree = _opened(trees)
            keys, ids, labels, points = _anchors(anchors)
            search = Search(tree, points)
            for k in range(len(ids)):
                allowed = (tree.labels == labels[k]) & (tree.ids != ids[k])
                for places, scores in search.best(k, allowed, [(-(2.0**63), 2.0**63)], count):
                    rows += [(keys[k], ids[k], i, s) for i, s in zip(tree.ids[places], scores)]
        return _table(rows, ["key", "id", "other", "score"])

    return positives


def _negatives(windows: Windows):
    def negatives(anchors: pa.Table, trees: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if anchors.num_rows and trees.num_rows:
            tree = _opened(trees)
            keys, ids, labels, points = _anchors(anchors)
            search = Search(tree, points)
            for k, wanted in enumerate(anchors.column("products").to_pylist()):
                allowed = (tree.labels != labels[k]) & (tree.ids != ids[k])
                # Least and largest whole product of each window, without empty ones.
                ends = [(p, -(-windows.least * p // 100), windows.most * p // 100) for p in sorted(set(wanted))]
                ends = [end for end in ends if end[1] <= end[2]]
                if not ends or not allowed.any():
                    continue
                found = search.best(k, allowed, [end[1:] for end in ends], windows.negatives)
                for (product, _, _), (places, scores) in zip(ends, found):
                    rows += [(keys[k], product, i, s) for i, s in zip(tree.ids[places], scores)]
        return _table(rows, ["key", "product", "other", "score"])

    return negatives


def forest(rows: DataFrame, size: int = TREE) -> DataFrame:
    """The trees, one a row, from ``id, label, vector``."""
    counts = rows.groupBy(F.col("label").alias("_label")).agg(F.count("*").alias("count"))
    counts = stored(counts, "label-rows")
    small = counts.filter(F.col("count") < size).agg(F.sum("count")).first()[0] or 0
    own = F.ceil(F.col("count") / size).cast("long")
    shared = F.pmod(F.xxhash64("label", F.lit(5)), F.lit(-(-small // size) or 1).cast("long"))
    chunk = F.when(F.col("count") < size, F.xxhash64(F.lit("shared"), shared)).otherwise(
        F.xxhash64("label", F.pmod(F.xxhash64("id", F.lit(3)), own))
    )
    dealt = rows.join(counts, F.col("label") == F.col("_label")).select(chunk.alias("tree"), "id", "label", "vector")
    return stored(dealt.groupBy("tree").applyInArrow(_build, TREES), "cover-trees")


def _met(anchors: DataFrame, trees: DataFrame, blocks: int, made, schema: str) -> DataFrame:
    """Anchors, each with the tree it looks into, meet the trees block by block."""
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int"))
    copies = trees.select(F.col("tree").alias("_tree"), "width", *PARTS, block)
    pairs = dealt.groupBy("tree", "block").cogroup(copies.groupBy("_tree", "_block"))
    return pairs.applyInArrow(made, schema)


def mine(
    vectors: DataFrame,
    anchor: Column,
    id: str = "id",
    label: str = "label",
    vector: str = "vector",
    windows: Windows | None = None,
    tree_rows: int = TREE,
    block_anchors: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` holds whole numbers; ``anchor``, a condition on ``vectors``, says which rows
    are anchors.
    """
    windows = windows or Windows()
    marked = vectors.withColumns({"_anchor": F.coalesce(anchor, F.lit(False))})
    own = named(marked, id=id, label=label, vector=vector, anchor="_anchor")
    own = own.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    bounded = F.transform("vector", lambda x: F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)).cast("long"))
    own = own.select(F.col("id").cast("long"), F.col("label").cast("long"), bounded.alias("vector"), "anchor")
    trees = forest(own, tree_rows)
    key = F.xxhash64("id", "label", "vector").alias("key")
    anchors = stored(own.filter("anchor").select(key, "id", "label", "vector").distinct(), "anchors")
    blocks = max(1, -(-anchors.count() // block_anchors))

    held = trees.select("tree", F.explode("held").alias("_label"))
    near = anchors.join(held, F.col("label") == F.col("_label")).drop("_label")
    schema = "key long, id long, other long, score long"
    found = _met(near, trees, blocks, _positives(windows.positives), schema)
    first = W.partitionBy("key").orderBy(F.desc("score"), "other")
    found = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= windows.positives)
    positives = stored(found.drop("rank"), "positives")

    wanted = positives.groupBy(F.col("key").alias("_key")).agg(F.collect_set("score").alias("products"))
    asked = anchors.join(wanted, F.col("key") == F.col("_key")).drop("_key")
    # Trees are numbered, so that each anchor can name all of them without a cross join.
    numbered = trees.select("tree", F.row_number().over(W.orderBy("tree")).alias("number"), "held")
    numbered = stored(numbered, "tree-numbers")
    count = numbered.count()
    every = asked.withColumn("_number", F.explode(F.sequence(F.lit(1), F.lit(max(1, count)))))
    every = every.join(numbered, F.col("_number") == F.col("number"))
    alone = (F.size("held") == 1) & (F.get("held", F.lit(0)) == F.col("label"))
    every = every.filter(~alone).drop("_number", "number", "held")
    schema = "key long, product long, other long, score long"
    best = _met(every, trees, blocks, _negatives(windows), schema)
    first = W.partitionBy("key", "product").orderBy(F.desc("score"), "other")
    best = best.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= windows.negatives)
    best = best.select(
        F.col("key").alias("_key"), "product", "rank",
        F.col("other").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    joined = positives.join(best, (F.col("key") == F.col("_key")) & (F.col("score") == F.col("product")))
    return joined.select(
        F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
