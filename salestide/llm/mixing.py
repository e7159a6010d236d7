"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words, and each of its documents the same share of it: a
whole number of copies and a fraction. Fractions become 0 or 1 in pairs: mass moves from
one document to the other at random until one of the two is whole. What moves is words,
not copies, so the words of a pair stay exactly what they were, while the expected copies
of each document stay its fraction. Documents meet in blocks first; each block leaves at
most one fraction, blocks of blocks combine those, up to one fraction per source. Larger
documents go first, and the last open fraction of a source is rounded to the nearer side,
so a source misses its target by at most half of one document.

All randomness is a hash of the document's id, so reruns agree however rows are
partitioned.

Defined results: NULL text has size 0; NULL is a source of its own, the last; documents of
size 0 are taken 0 times; repeated rows and ids count each for itself and share one
outcome if all else is equal; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salestide.llm.rows import fresh, named
from salestide.session import stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: About so many documents meet in a block, and so many blocks in the next one.
BLOCK_ROWS = 4096
FAN_IN = 64
#: A fraction closer to 0 or 1 than this is whole.
TINY = 1e-9


def pivot(size: np.ndarray, part: np.ndarray, luck: np.ndarray) -> tuple[np.ndarray, int]:
    """Fractions made whole pair by pair, in the given order, and which one is left (or -1).

    ``luck`` holds a number from 0 to 1 for each document and decides its pairing with
    the one still open.
    """
    part = part.copy()
    is_open = -1
    for k in range(len(part)):
        if part[k] < TINY or part[k] > 1 - TINY:
            part[k] = round(part[k])
            continue
        if is_open < 0:
            is_open = k
            continue
        i = is_open
        up = min((1 - part[i]) * size[i], part[k] * size[k])
        down = min(part[i] * size[i], (1 - part[k]) * size[k])
        moved = up if luck[k] * (up + down) < down else -down
        part[i] += moved / size[i]
        part[k] -= moved / size[k]
        whole = [part[x] < TINY or part[x] > 1 - TINY for x in (i, k)]
        if whole[0]:
            part[i] = round(part[i])
        if whole[1]:
            part[k] = round(part[k])
        is_open = -1 if all(whole) else k if whole[0] else i
    return part, is_open


def _combine(root: bool) -> Callable[[pa.Table], pa.Table]:
    """One block: largest documents first, ties by their hash."""

    def combine(block: pa.Table) -> pa.Table:
        block = block.sort_by([("mass", "descending"), ("luck", "ascending")])
        mass, part, luck = (block[name].to_numpy() for name in ("mass", "part", "luck"))
        part, is_open = pivot(mass.astype(float), part, luck)
        if root and is_open >= 0:
            part[is_open] = float(part[is_open] >= 0.5)
        return block.set_column(block.schema.get_field_index("part"), "part", pa.array(part))

    return combine


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds ``place``, the source's number from 0 in order, NULL last.

    Sources are sorted in ranges; only the ranges are numbered in one task.
    """
    order = F.asc_nulls_last("source")
    ranged = sources.repartitionByRange(order).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "sources")
    counts = ranged.groupBy(F.col("range").alias("_range")).agg(F.count("*").alias("count"))
    before = F.sum("count").over(W.orderBy("_range")) - F.col("count")
    starts = counts.select("_range", before.alias("before"))
    rows = ranged.join(starts, F.col("range") == F.col("_range"))
    place = F.col("before") + F.row_number().over(W.partitionBy("range").orderBy(order)) - 1
    return rows.select("source", "source_size", place.alias("place"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources stand in order of their code points, NULL last, and take the weights in turn.
    A target stops at ``most`` times the size; what is over goes to the others by weight.
    Each round finds all sources that are over and is one small aggregate; the number of
    rounds is bounded by the number of sources and is a few in practice.
    """
    own = _numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    turn = (F.col("place") % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn).cast("double")
    own = stored(own.withColumn("weight", weight), "source-sizes")
    most_words = F.col("source_size") * most
    words = share * (own.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else most_words < F.col("weight") * level
        found = own.agg(
            F.count(F.when(over, 1)),
            F.sum(F.when(over, most_words)),
            F.sum(F.when(~over, F.col("weight"))),
        ).first()
        if found[0] == capped or not found[2]:
            break
        capped, level = found[0], (words - (found[1] or 0.0)) / found[2]
    target = F.least(most_words, F.col("weight") * F.lit(level or 0.0))
    return own.select("source", F.col("source_size").cast("long"), target.alias("target"))


def text_size(text: Column) -> Column:
    """Words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """``id, source, size, source_size, target, copies, taken`` for every document."""
    sizes = named(docs, id=id, source=source, text=text)
    sizes = sizes.select("id", "source", text_size(F.col("text")).alias("size"))
    sizes = stored(sizes, "sizes")
    targets = source_targets(sizes, weights, share, most)
    keyed = targets.select(F.col("source").alias("_source"), "source_size", "target")
    share_of = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    wanted = sizes.join(keyed, sizes["source"].eqNullSafe(keyed["_source"])).select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce(F.when(F.col("size") > 0, share_of), F.lit(0.0)).alias("wanted"),
    )
    whole = F.floor("wanted").cast("long")
    fraction = F.col("wanted") - F.floor("wanted")
    # Equal rows share one outcome and count as one document of their words together.
    open_rows = wanted.filter((fraction >= TINY) & (fraction <= 1 - TINY))
    parts = open_rows.groupBy("source", "id", "size").agg(
        (F.count("*") * F.col("size")).alias("mass"), F.max(fraction).alias("part")
    )
    made = _rounded(parts, sizes.count(), seed)
    key = ["source", "id", "size"]
    made = made.select(*[F.col(c).alias(f"_{c}") for c in key], "part")
    same = [wanted[c].eqNullSafe(made[f"_{c}"]) for c in key]
    nearly = F.when(fraction > 1 - TINY, 1).otherwise(0)
    copies = whole + F.coalesce(F.col("part").cast("long"), nearly)
    return (
        wanted.join(made, same, "left")
        .withColumn("copies", copies)
        .select(
            "id", "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def _rounded(parts: DataFrame, documents: int, seed: int) -> DataFrame:
    """``source, id, size, part`` with every part 0 or 1.

    Levels of the tree: blocks of a source are numbered by a hash of the id; each level
    divides the number by ``FAN_IN``. Each level is stored, so the next one reads only
    what it has left open, and a lost executor costs tasks of one level.
    """
    blocks = max(1, documents // BLOCK_ROWS)
    rows = parts.withColumn("level", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(blocks)))
    done, turn = [], 0
    while True:
        bits = F.shiftrightunsigned(F.xxhash64("id", "size", F.lit(seed + 1 + turn)), 11)
        rows = rows.withColumn("luck", bits / F.lit(2.0**53))
        groups = rows.groupBy("source", "level")
        state = stored(groups.applyInArrow(_combine(blocks == 1), rows.schema), "pivots")
        is_open = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(state.filter(~is_open))
        if blocks == 1:
            return reduce(DataFrame.unionByName, done).select("source", "id", "size", "part")
        blocks = -(-blocks // FAN_IN)
        rows = state.filter(is_open).withColumn("level", F.floor(F.col("level") / FAN_IN))
        turn += 1


def take(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The documents that the mix takes, with their columns and the number of ``copies``."""
    rows = mix(docs, id, text, source, **options).filter(F.col("copies") > 0)
    names = {c: fresh(docs, f"_{c}") for c in ("id", "source", "size")}
    copies = fresh(docs, "copies")
    rows = rows.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("copies").alias(copies))
    rows = stored(rows.distinct(), "taken")
    same = docs[id].eqNullSafe(rows[names["id"]]) & docs[source].eqNullSafe(rows[names["source"]])
    same = same & (text_size(docs[text]) == rows[names["size"]])
    return docs.join(rows, same).select(*[docs[c] for c in docs.columns], rows[copies])
