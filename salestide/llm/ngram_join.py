"""Jaccard self-join on word shingles with signature trees.

1. *Sets.* Each text becomes the sorted codes of its distinct shingles. Texts with one and
   the same set are one node from here on.
2. *Roots.* The tree's top level must not hold all documents, so it is cut by a rule that
   loses no pair: codes are dealt by value to more cells than two linked sets of that size
   class can differ in, so linked sets agree in several whole cells. Of these the one with
   the most codes is enough, so cells of few codes, which also agree by chance, are left
   out. Nodes that agree in a cell hang under one root, named by the smallest of them.
3. *Trees.* Under each root the nodes form leaves; a tree node holds the OR of its token
   bitmaps, the range of its sizes and the most tokens that share a bit. A dual traversal
   of the tree with itself drops pairs of tree nodes whose largest possible overlap is too
   small. A first traversal has the bitmaps only and finds which nodes have a possible
   partner; their sets alone are sent to the second, with wider bitmaps, which also drops
   pairs that are one component already and decides the rest by exact intersection.
4. *Components* of the links found are joined by distributed union-find.

A root's nodes are dealt to chunks of bounded size and every two chunks meet in a task, so
no group has to fit one task. Texts of nodes that share no cell never leave their task.

Defined results: NULL, empty and blank texts have no shingles and link with nothing; texts
shorter than a shingle are one shingle; a row whose id is NULL takes part and gets the
smallest id of its component that there is; repeated rows are exact copies; with no
documents there are no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.components import components
from salestide.llm.rows import fresh, named
from salestide.llm.shingles import code_sets, mix
from salestide.session import scratch, stored

LEAF = 64
FAN_OUT = 8
#: Bits of a token bitmap for each token of the set.
BITS = 8
#: The same for the bitmaps of the first traversal.
FEW_BITS = 2
#: Words of bitmaps that are compared in one go.
AT_ONCE = 1 << 18
#: A class has a cell to spare for every so many that linked sets can differ in, and one more.
SPARE = 4
#: Codes that a chunk of a root's nodes holds, about.
CHUNK_CODES = 2_000_000


@dataclass(frozen=True)
class Measure:
    """Linked if ``whole * intersection >= part * union``."""

    width: int = 3
    part: int = 90
    whole: int = 100

    def linked(self, both, size_a, size_b):
        return self.whole * both >= self.part * (size_a + size_b - both)

    def differences(self, size_a: int, size_b: int) -> int:
        """The most codes in one but not both of two linked sets of at most these sizes."""
        return (self.whole - self.part) * (size_a + size_b) // (self.whole + self.part)

    def classes(self, most: int = 2**40) -> list[int]:
        """Smallest size of each class. Linked sets are in one class or in neighbours."""
        starts, step = [1], max(1.5, self.whole / self.part)
        while starts[-1] < most:
            starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] * step))))
        return starts


def cell_keys(codes: np.ndarray, measure: Measure, starts: np.ndarray) -> np.ndarray:
    """Keys that two linked sets share one of, from the set's own size class and, where
    linked sets can be there, from the next one.

    Each code that two sets do not share spoils one cell at most, so that of a class's cells
    linked sets agree in all but as many. With cells to spare a set may leave some out: those
    of the fewest codes, which sets agree in by chance. The cells that it keeps are one more
    than it can differ in from a linked set of the class, so of all cells that two linked
    sets agree in both keep the one that is last in this order.

    Cells without codes would be the same in all sets. A set that had to keep one gets the
    first of its codes as keys instead: linked sets share one of those too.
    """
    own = int(np.searchsorted(starts, len(codes), "right")) - 1
    reach = len(codes) * measure.whole // measure.part
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes, 1), out=sums[1:])
    keys = []
    for level in (own, own + 1)[: 1 + (reach >= starts[own + 1])]:
        most = int(starts[level + 1]) - 1
        apart = measure.differences(len(codes), min(reach, most))
        if not apart:
            continue
        widest = measure.differences(most, most)
        cells = widest + 2 + widest // SPARE
        bounds = (np.arange(1, cells, dtype=np.float64) * (2.0**64 / cells)).astype(np.uint64)
        ends = np.r_[0, np.searchsorted(codes, bounds), len(codes)]
        number = np.arange(cells, dtype=np.uint64) + np.uint64((level + 1) << 40)
        made = mix(mix(number, 2) + sums[ends[1:]] - sums[ends[:-1]])
        count = np.diff(ends)
        kept = np.lexsort((made, count))[cells - apart - 1 :]
        if not count[kept[0]]:
            kept = kept[count[kept] > 0]
            first = len(codes) * (measure.whole - measure.part) // measure.whole + 1
            keys.append(mix(mix(codes[:first], 6) + np.uint64(level)))
        keys.append(made[kept])
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def _features(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.array(measure.classes())
        for batch in batches:
            sizes, nodes, keys, bits = [], [], [], []
            for codes in code_sets(batch.column("text"), measure.width):
                sizes.append(len(codes))
                nodes.append(set_node(codes) if len(codes) else None)
                keys.append(cell_keys(codes, measure, starts) if len(codes) else [])
                bits.append(few_bits(codes, starts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("copy"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(bits, pa.binary()),
                ],
                ["id", "copy", "n_shingles", "node", "cells", "bits"],
            )

    return features


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of ``bits`` bits, a power of two, for each set, as 64-bit words."""
    row = np.repeat(np.arange(len(sets)), [len(codes) for codes in sets])
    bit = (np.concatenate(sets) >> np.uint64(20)) % np.uint64(bits)
    maps = np.zeros((len(sets), bits), bool)
    maps[row, bit.astype(np.int64)] = True
    return np.packbits(maps, axis=1).view(np.uint64)


def few_bits(codes: np.ndarray, starts: np.ndarray) -> bytes:
    """The bitmap of a set for the first traversal, as wide as its size class asks for."""
    if not len(codes):
        return b""
    most = int(starts[np.searchsorted(starts, len(codes), "right")]) - 1
    return bitmaps([codes], _width(FEW_BITS * most)).tobytes()


def _width(bits: int) -> int:
    return max(64, 1 << (bits - 1).bit_length())


def as_wide(maps: list[bytes]) -> np.ndarray:
    """Bitmaps folded to the width of the narrowest, which keeps what they can say."""
    width = min(map(len, maps))
    folded = np.zeros((len(maps), width), np.uint8)
    for at, one in enumerate(maps):
        np.bitwise_or.reduce(np.frombuffer(one, np.uint8).reshape(-1, width), out=folded[at])
    return folded.view(np.uint64)


def set_node(codes: np.ndarray) -> int:
    """One number for a whole set: two hashes of it, mixed into one."""
    one, two = (mix(codes, salt).sum(dtype=np.uint64) for salt in (3, 4))
    return int(mix(np.array([one]) ^ mix(np.array([two]), 5)).view(np.int64)[0])


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The codes of each text that is its node's; another text may share its id."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            found = zip(nodes, code_sets(batch.column("text"), width))
            kept = [(node, codes.view(np.int64)) for node, codes in found if set_node(codes) == node]
            arrays = [
                pa.array([node for node, _ in kept], pa.int64()),
                pa.array([codes for _, codes in kept], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "codes"])

    return sets


class SignatureTree:
    """Sizes and token bitmaps of sets in order, and levels of nodes over them."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray):
        self.sizes, self.maps = sizes, maps
        self.ends = np.r_[0, np.cumsum(sizes)]
        self.excess = excess = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels, step = [], LEAF
        maps, least, most = self.maps, self.sizes, self.sizes
        while True:
            at = np.arange(0, len(maps), step)
            maps = np.bitwise_or.reduceat(maps, at)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            excess = np.maximum.reduceat(excess, at)
            self.levels.append((maps, least, most, excess))
            if len(maps) == 1:
                break
            step = FAN_OUT


class Join:
    """The dual traversal of the trees of two lists of sets, or of one with itself.

    ``label`` names each set's component so far, smallest index first; sets of one
    component are not compared again.
    """

    def __init__(self, measure: Measure, a: list[np.ndarray], b: list[np.ndarray] | None = None):
        self.measure, self.same = measure, b is None
        sets = a if b is None else a + b
        bits = _width(BITS * max(map(len, sets)))
        self.a = SignatureTree(np.array([len(one) for one in a]), bitmaps(a, bits))
        self.b = self.a
        if b is not None:
            self.b = SignatureTree(np.array([len(one) for one in b]), bitmaps(b, bits))
        self.shift = 0 if b is None else len(a)
        _, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(self.tokens) + 1, bool)
        self.label = np.arange(len(sets))

    def run(self) -> np.ndarray:
        top = max(len(self.a.levels), len(self.b.levels)) - 1
        ends = [t.levels[-1] for t in (self.a, self.b)]
        if self.possible(ends[0], range(1), ends[1], range(1)).any():
            self.visit(top, 0, 0)
        return self.label

    def possible(self, a: tuple, of_a: range, b: tuple, of_b: range) -> np.ndarray:
        """Which of two ranges of nodes, or sets, can hold linked sets, by size ranges and bitmaps."""
        maps_a, least_a, most_a, excess_a = (x[of_a.start : of_a.stop, None] for x in a)
        maps_b, least_b, most_b, excess_b = (x[None, of_b.start : of_b.stop] for x in b)
        m = self.measure
        fits = (m.whole * most_a >= m.part * least_b) & (m.whole * most_b >= m.part * least_a)
        if not fits.any():
            return fits
        if fits.size * maps_a.shape[-1] <= AT_ONCE:
            shared = np.bitwise_count(maps_a & maps_b).sum(axis=2, dtype=np.int64)
        else:
            shared = np.stack([np.bitwise_count(row & maps_b[0]).sum(axis=1, dtype=np.int64) for row in maps_a])
        overlap = shared + np.minimum(excess_a, excess_b)
        overlap = np.minimum(overlap, np.minimum(most_a, most_b))
        return fits & (overlap * (m.whole + m.part) >= m.part * (least_a + least_b))

    def visit(self, level: int, i: int, j: int) -> None:
        """Nodes i and j of a level, which can hold linked sets; a tree of fewer levels waits
        at its root."""
        if level == 0:
            self.leaves(i, j)
            return
        la, lb = (min(level, len(t.levels) - 1) for t in (self.a, self.b))
        below_a, below_b = self._children(self.a, level, la, i), self._children(self.b, level, lb, j)
        la, lb = (min(level - 1, len(t.levels) - 1) for t in (self.a, self.b))
        fits = self.possible(self.a.levels[la], below_a, self.b.levels[lb], below_b)
        for x, y in np.argwhere(fits).tolist():
            x, y = below_a[x], below_b[y]
            if not self.same or x <= y:
                self.visit(level - 1, x, y)

    @staticmethod
    def _children(tree: SignatureTree, level: int, own: int, i: int) -> range:
        if own < level:
            return range(i, i + 1)
        return range(i * FAN_OUT, min((i + 1) * FAN_OUT, len(tree.levels[own - 1][0])))

    def leaves(self, i: int, j: int) -> None:
        a, b = self.a, self.b
        of_a = range(i * LEAF, min((i + 1) * LEAF, len(a.sizes)))
        of_b = range(j * LEAF, min((j + 1) * LEAF, len(b.sizes)))
        sets = [(t.maps, t.sizes, t.sizes, t.excess) for t in (a, b)]
        fits = self.possible(sets[0], of_a, sets[1], of_b)
        if self.same and i == j:
            fits = np.triu(fits, 1)
        self.meet(of_a, of_b, fits)

    def meet(self, of_a: range, of_b: range, fits: np.ndarray) -> None:
        for k in np.flatnonzero(fits.any(axis=1)):
            x, rows = of_a[k], of_b.start + np.flatnonzero(fits[k])
            rows = rows[self.label[rows + self.shift] != self.label[x]]
            if len(rows):
                self.verify(x, rows)

    def verify(self, x: int, rows: np.ndarray) -> None:
        a, b = self.a, self.b
        own = self.tokens[a.ends[x] : a.ends[x + 1]]
        self.mark[own] = True
        skip = a.ends[-1] if self.shift else 0
        for y in rows:
            if self.label[y + self.shift] == self.label[x]:
                continue
            both = int(self.mark[self.tokens[skip + b.ends[y] : skip + b.ends[y + 1]]].sum())
            if self.measure.linked(both, a.sizes[x], b.sizes[y]):
                one, two = sorted((self.label[x], self.label[y + self.shift]))
                self.label[self.label == two] = one
        self.mark[own] = False


class Partners(Join):
    """The traversal on bitmaps alone: which sets may have a partner."""

    def __init__(self, measure: Measure, sizes: np.ndarray, maps: np.ndarray, first: int | None = None):
        self.measure, self.same = measure, first is None
        self.a = self.b = SignatureTree(sizes[:first], maps[:first])
        if first is not None:
            self.b = SignatureTree(sizes[first:], maps[first:])
        self.shift = first or 0
        self.label = np.arange(len(sizes))
        self.found = np.zeros(len(sizes), bool)

    def visit(self, level: int, i: int, j: int) -> None:
        """Two tree nodes whose sets all have a partner are not looked into."""
        span = LEAF * FAN_OUT**level
        below = [self.found[: len(self.a.sizes)], self.found[self.shift :]]
        if not all(found[k * span : (k + 1) * span].all() for found, k in zip(below, (i, j))):
            super().visit(level, i, j)

    def meet(self, of_a: range, of_b: range, fits: np.ndarray) -> None:
        self.found[of_a.start : of_a.stop] |= fits.any(axis=1)
        self.found[of_b.start + self.shift : of_b.stop + self.shift] |= fits.any(axis=0)


def _partners(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by task, those that may have a partner in the task."""

    def task(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        rows.sort(key=lambda row: (row[1], row[4]))
        first = sum(row[1] == 0 for row in rows)
        if not first or (first == 1 and len(rows) == 1):
            return []
        sizes = np.array([row[3] for row in rows])
        search = Partners(measure, sizes, as_wide([row[4] for row in rows]), first if first < len(rows) else None)
        search.run()
        return [row[:3] for row, found in zip(rows, search.found) if found]

    names = ["task", "side", "node", "size", "bits"]
    kinds = [pa.int64(), pa.int32(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*task(rows))) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[:3])

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(name).to_pylist() for name in names]):
                if rows and rows[0][0] != row[0]:
                    yield made(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield made(rows)

    return partners


def _links(measure: Measure) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by task; each task's links are a star over its components."""

    def task(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        sides: list[list] = [[], []]
        for _, side, node, codes in rows:
            sides[side].append((node, codes))
        nodes, sets = [], []
        for side in sides:
            side.sort(key=lambda one: int(one[1][0]))
            nodes.append(np.array([node for node, _ in side], np.int64))
            sets.append([codes for _, codes in side])
        if not sets[0] or (len(sets[0]) < 2 and not sets[1]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        label = Join(measure, sets[0], sets[1] or None).run()
        nodes = np.concatenate(nodes)
        hung = label != np.arange(len(label))
        return nodes[hung], nodes[label[hung]]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            number, side, node = (batch.column(c).to_numpy() for c in ("task", "side", "node"))
            lists = batch.column("codes")
            values = lists.values.to_numpy().view(np.uint64)
            ends = lists.offsets.to_numpy()
            for k in range(len(number)):
                if rows and rows[0][0] != number[k]:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in task(rows)], schema=schema)
                    rows = []
                codes = values[ends[k] : ends[k + 1]].copy()
                rows.append((number[k], side[k], node[k], codes))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in task(rows)], schema=schema)

    return links


def _tasks(members: DataFrame, codes_per_chunk: int) -> DataFrame:
    """``task, side, node``: every two chunks of a root's nodes meet in a task.

    ``members``: ``root, node, size``. A root of few nodes is one task.
    """
    roots = members.groupBy("root").agg(F.sum("size").alias("codes"), F.count("*").alias("nodes"))
    roots = roots.filter(F.col("nodes") > 1).select(
        F.col("root").alias("_root"),
        F.ceil(F.col("codes") / codes_per_chunk).cast("int").alias("chunks"),
    )
    own = F.pmod(F.xxhash64("node", F.lit(11)), F.col("chunks")).cast("int")
    rows = members.join(roots, F.col("root") == F.col("_root")).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    rows = rows.select("root", "node", "own", other)
    pair = [F.least("own", "other"), F.greatest("own", "other")]
    side = F.when(F.col("own") <= F.col("other"), 0).otherwise(1)
    return rows.select(F.xxhash64("root", *pair).alias("task"), side.alias("side"), "node")


def join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    measure: Measure | None = None,
    codes_per_chunk: int = CHUNK_CODES,
) -> DataFrame:
    """``id, copy, n_shingles, component`` for every row; ``copy`` is a hash of the text,
    which tells rows apart that share an id."""
    measure = measure or Measure()
    own = named(docs, id=id, text=text)
    kind = own.schema["id"].dataType.simpleString()
    marked = own.withColumn("copy", F.xxhash64("text"))
    schema = f"id {kind}, copy long, n_shingles long, node long, cells array<long>, bits binary"
    features = stored(marked.mapInArrow(_features(measure), schema), "shingle-cells")
    with scratch(docs.sparkSession):
        hung = _hung(marked, features, measure, codes_per_chunk)
        hung = stored(hung, "shingle-tops", keep=True)
    return _labelled(features.drop("cells", "bits"), hung)


def _hung(marked: DataFrame, features: DataFrame, measure: Measure, codes_per_chunk: int) -> DataFrame:
    """``node, root`` of the components."""
    # Dealt once by cell: both sides of the join read the same shuffle. Filtered here, as Spark
    # infers the filter for one side alone, which would then be another shuffle.
    keyed = features.filter("node is not null").select(F.explode("cells").alias("cell"), "node").repartition("cell")
    roots = keyed.groupBy("cell").agg(F.min("node").alias("root"), F.max("node").alias("_last"))
    roots = roots.filter(F.col("root") != F.col("_last")).select(F.col("cell").alias("_cell"), "root")
    pairs = keyed.join(roots, F.col("cell") == F.col("_cell")).select("root", "node").distinct()
    nodes = features.filter("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "copy")).alias("text"), F.first("n_shingles").alias("size"), F.first("bits").alias("bits")
    )
    sized = nodes.select(F.col("node").alias("_node"), "size")
    members = pairs.join(sized, F.col("node") == F.col("_node")).select("root", "node", "size")
    tasks = _tasks(stored(members, "roots"), codes_per_chunk)
    marks = nodes.select(F.col("node").alias("_node"), "size", "bits")
    tasks = tasks.join(marks, F.col("node") == F.col("_node"))
    tasks = tasks.select("task", "side", "node", "size", "bits")
    tasks = tasks.repartition("task").sortWithinPartitions("task")
    tasks = tasks.mapInArrow(_partners(measure), "task long, side int, node long")
    tasks = stored(tasks, "tree-tasks")
    # One text for each node that has company, then its codes, then its tasks. A text is
    # found by id and hash together, so that one whose rows have no id is found as well.
    wanted = tasks.select(F.col("node").alias("_node")).distinct()
    wanted = nodes.join(wanted, F.col("node") == F.col("_node"), "left_semi")
    wanted = wanted.select("node", F.col("text.id").alias("_id"), F.col("text.copy").alias("_copy"))
    same = (marked["copy"] == wanted["_copy"]) & marked["id"].eqNullSafe(wanted["_id"])
    texts = marked.join(wanted, same).select("node", "text")
    sets = texts.mapInArrow(_sets(measure.width), "node long, codes array<long>")
    sets = sets.select(F.col("node").alias("_node"), "codes")
    work = tasks.join(sets, F.col("node") == F.col("_node")).select("task", "side", "node", "codes")
    work = work.repartition("task").sortWithinPartitions("task")
    links = work.mapInArrow(_links(measure), "a long, b long")
    return components(links, "a", "b")


def _labelled(features: DataFrame, hung: DataFrame) -> DataFrame:
    """The smallest id of each row's component; its own id where it has no set."""
    hung = hung.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rows = features.join(hung, F.col("node") == F.col("_node"), "left")
    rows = rows.select("id", "copy", "n_shingles", F.coalesce("_root", "node").alias("top"))
    least = rows.filter("top is not null").groupBy(F.col("top").alias("_top"))
    # Stored, so that the join shuffles both sides itself and can split a hot component.
    least = stored(least.agg(F.min("id").alias("least")), "components")
    component = F.coalesce("least", "id").alias("component")
    joined = rows.join(least, F.col("top") == F.col("_top"), "left")
    return joined.select("id", "copy", "n_shingles", component)


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", measure: Measure | None = None
) -> DataFrame:
    """Of each component the document with the smallest id, with its columns.

    Documents without words stay. Rows that repeat id and text stay or go together.
    """
    one, two = fresh(docs, "_id"), fresh(docs, "_copy")
    with scratch(docs.sparkSession):
        rows = join(docs, id, text, measure or Measure(width=5, part=80))
        gone = rows.filter(F.col("id") != F.col("component"))
        gone = gone.select(F.col("id").alias(one), F.col("copy").alias(two)).distinct()
        gone = stored(gone, "near-copies", keep=True)
    same = (docs[id] == gone[one]) & (F.xxhash64(docs[text]) == gone[two])
    return docs.join(gone, same, "left_anti")
