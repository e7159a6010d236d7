"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

1. Lines are normalised (A-Z in lower case, white space to one blank, trimmed) and hashed; equal
   lines are one node. A line's set are its runs of eight characters, one from each
   character on; a shorter line is one shingle.
2. Every shingle of a line is hashed, and the line's signature are the smallest hashes in sixteen
   orders. A band are four of them, a row, a column or a diagonal of the signature in a square, so two
   lines share a band with the fourth power of their similarity and two bands have one hash
   in common at most. Measured against all pairs on the small tables, more than 97 % of the lines
   that repeat another one are found.
3. Each line of a bucket meets the bucket's most frequent one. Sizes and parity bitmaps of the
   shingle sets bound the Jaccard index from above, and only pairs that they leave possible are
   compared, by the exact index.
4. In buckets that still hold several components, chunks of lines meet in the same way until every
   two lines of different components have met: no link between lines that share a band is lost.
5. Links are joined by distributed union-find, and of each component the first line by
   document and place stays.

Signatures are combined in each task before the first shuffle, which carries no text. Texts are read again for the lines that share a bucket.

Defined results: lines are split at ``\\n``; blank lines are no nodes and stay; a line
shorter than a shingle is one shingle; NULL and empty texts have no lines and stay as they
are; rows that repeat both id and text count as one and keep the same lines; a NULL id
comes first; no documents give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.components import components
from salestide.llm.rows import LOWER, UPPER, fresh, named
from salestide.session import scratch, stored

#: What a blank line consists of.
BLANKS = " \t\x0b\x0c\r"
#: Wide characters that ``lower`` may change, with those that are not assigned yet.
CASED = r"[\x{80}-\x{10FFFF}&&[\p{IsUppercase}\p{IsTitlecase}\p{Cn}]]"
#: Characters of a shingle.
SHINGLE = 8
#: What stands before a shingle of the sample.
BEFORE = "[ 05\\x{2E80}-\\x{10FFFF}]"
SKETCH = 32
BANDS, BAND_ROWS = 10, 4
#: Places of the signature in each of sixteen bands: rows, columns and two sorts of diagonals of a
#: square (lines of the affine plane of order four), of which no two have two places in common.
SQUARE = [[4 * r + c for c in range(4)] for r in range(4)] + [[4 * r + c for r in range(4)] for c in range(4)]
SQUARE += [[4 * r + (x ^ d) for r, x in enumerate(turn)] for turn in ((0, 1, 2, 3), (0, 2, 3, 1)) for d in range(4)]
#: Shingles that are hashed or marked in one row; they are combined before the rows are.
TOGETHER = 16
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Lines of a bucket that meet another such chunk in one go, about.
CHUNK = 4000
#: Words of 64 bits in a parity bitmap, a power of two.
WORDS = 16


def normalised(line: Column) -> Column:
    """A-Z in lower case, blanks for white space, one at a time, none at the ends."""
    blanks = "\t\x0b\x0c\r"
    # Without wide letters that have a lower case ``lower`` does the same, much faster.
    same = (F.octet_length(line) == F.length(line)) | ~line.rlike(CASED)
    low = F.when(same, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    plain = F.when(line.rlike(f"[{blanks}]"), F.translate(low, blanks, " " * 4)).otherwise(low)
    single = F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " "))
    return F.btrim(single.otherwise(plain))


def _windows(line: Column) -> Column:
    """Hashes of the character shingles of a normalised line, in order.

    Windows are cut from four bytes a character, so that each is found by its place. The
    bytes are bound by a lambda: a column would be computed again for each window.
    """

    def windows(wide: Column) -> Column:
        last = F.greatest(F.length(wide) - (4 * SHINGLE - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last, F.lit(4)), lambda at: F.xxhash64(F.substring(wide, at, F.lit(4 * SHINGLE))))

    return F.transform(F.array(F.encode(line, "UTF-32")), windows)[0]


def character_set(line: Column) -> Column:
    """Hashes of the distinct character shingles of a normalised line."""
    return F.array_distinct(_windows(line))


def sampled(line: Column) -> Column:
    """Hashes of a normalised line's shingles that belong to the sample, in order.

    With ``bands`` the earlier signature, which the operator uses no more; see ``signatures``.
    """
    found = F.regexp_extract_all(F.concat(F.lit(" "), line), F.lit(f"(?s){BEFORE}(?=(.{{1,{SHINGLE}}}))"), F.lit(1))
    return F.sort_array(F.array_distinct(F.transform(found, lambda window: F.xxhash64(window))))


def bands(sketch: Column) -> Column:
    """A key for each band; the sketch must be a column.

    A band orders the hashes by all their bits, each turned over or not, which is another
    order for each band and costs less than hashing them again.
    """

    def key(band: int) -> Column:
        turned = (band + 1) * 0x9E3779B97F4A7C15 % 2**64 - 2**63
        ordered = F.sort_array(F.transform(sketch, lambda x: x.bitwiseXOR(F.lit(turned))))
        return F.xxhash64(F.slice(ordered, 1, BAND_ROWS), F.lit(band))

    return F.array(*[key(band) for band in range(BANDS)])


def _order(k: int) -> int:
    """What turns hashes into the order of the signature's place ``k``."""
    return (2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64 - 2**63


def signatures(lines: DataFrame) -> DataFrame:
    """``node, n, bands`` of each node of ``node, line``, with the number of its lines.

    The smallest hash in each order, over the shingles at all characters. Rows of shingles are
    generated and combined without functions of arrays, which Spark does not compile.
    """
    wide = lines.select("node", F.encode("line", "UTF-32").alias("wide"))
    last = F.greatest((F.length("wide") / 4).cast("int") - SHINGLE, F.lit(0)).alias("last")
    rows = wide.select("node", "wide", last)
    begins = F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(TOGETHER))).alias("begin")
    rows = rows.select("node", "wide", "last", begins)
    # Behind the last shingle it is taken again, which changes no minimum.
    place = lambda j: F.least(F.col("begin") + j, F.col("last")) * 4 + 1
    hashes = [F.xxhash64(F.substring("wide", place(j), F.lit(4 * SHINGLE))).alias(f"h{j}") for j in range(TOGETHER)]
    rows = rows.select("node", (F.col("begin") == 0).alias("starts"), *hashes)
    least = [F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(_order(k))) for j in range(TOGETHER)]) for k in range(16)]
    made = rows.groupBy("node").agg(F.count_if("starts").alias("n"), *[F.min(x).alias(f"m{k}") for k, x in enumerate(least)])
    keys = [F.xxhash64(*[F.col(f"m{k}") for k in places], F.lit(band)) for band, places in enumerate(SQUARE)]
    return made.select("node", "n", F.array(*keys).alias("bands"))


def raw_lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id, copy, pos, raw`` for every line that is not blank.

    ``copy`` is a hash of the text, which tells rows apart that share an id.
    """
    # The hash has a step of its own: beside the lines it would be computed again for each.
    own = named(docs, id=id, text=text).select("id", "text", F.xxhash64("text").alias("copy"))
    rows = own.select("id", "copy", F.posexplode(F.split("text", "\n")))
    rows = rows.select("id", "copy", "pos", F.col("col").alias("raw"))
    # Before lines are normalised: a filter on the result would normalise them twice.
    return rows.filter(F.ltrim("raw", F.lit(BLANKS)) != "")


def _own_lines(docs: DataFrame, id: str, text: str, wanted: DataFrame) -> DataFrame:
    """``node, line`` of the ``node, place`` wanted, read once from each document that has any."""
    own = named(docs, id=id, text=text).select("id", "text", F.xxhash64("text").alias("copy"))
    lists = wanted.groupBy(F.col("place.id").alias("_id"), F.col("place.copy").alias("_copy")).agg(
        F.collect_list(F.struct("node", "place.pos")).alias("found")
    )
    rows = own.join(lists, (F.col("copy") == F.col("_copy")) & F.col("id").eqNullSafe(F.col("_id")))
    # Bound by a lambda: a column would be split again for each line.
    lines = F.transform(
        F.array(F.split("text", "\n")),
        lambda parts: F.transform("found", lambda x: F.struct(x["node"].alias("node"), F.get(parts, x["pos"]).alias("raw"))),
    )
    rows = rows.select(F.explode(lines[0]).alias("x")).select("x.node", "x.raw")
    rows = rows.groupBy("node").agg(F.first("raw").alias("raw"))
    return rows.select("node", normalised(F.col("raw")).alias("line"))


def _buckets(signed: DataFrame) -> DataFrame:
    """``band, node, n`` of the bands that several nodes of ``node, n, bands`` share."""
    # Dealt once, to find the buckets of several lines and for the join, which reads the lines
    # of a bucket one by one past its one row.
    keyed = signed.select(F.explode("bands").alias("band"), "node", "n").repartition("band")
    # Asks for all columns, as Spark deals twice what it may read with fewer.
    several = keyed.groupBy(F.col("band").alias("_band")).agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.sum("n").alias("lines")
    )
    several = several.filter((F.col("low") < F.col("high")) & (F.col("lines") > 1)).select("_band").hint("shuffle_hash")
    return keyed.join(several, F.col("band") == F.col("_band")).drop("_band")


def _to_first(shared: DataFrame) -> DataFrame:
    """Pairs ``a, b``: each line of a bucket with the bucket's first one."""
    rows = shared.filter(F.col("node") != F.col("first"))
    return rows.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()


def _possible() -> list[Column]:
    """Conditions that the marks of two similar sets, ``_a`` and ``_b``, meet.

    Two sets that differ in d shingles have bitmaps that differ in d bits at most, and similar sets
    of n shingles together differ in (100 - PERCENT) / (100 + PERCENT) * n at most.
    """
    differ = [F.bit_count(F.col(f"bits_{k}_a").bitwiseXOR(F.col(f"bits_{k}_b"))) for k in range(WORDS)]
    both = F.col("size_a") + F.col("size_b")
    found = F.abs(F.col("size_a") - F.col("size_b")), sum(differ[1:], differ[0])
    return [(100 + PERCENT) * least <= (100 - PERCENT) * both for least in found]


def _left_possible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` that may be similar by their marks."""
    one, two = (marks.toDF(f"_{n}", *[f"{c}_{n}" for c in marks.columns[1:]]) for n in "ab")
    rows = pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
    for condition in _possible():
        rows = rows.filter(condition)
    return rows.select("a", "b")


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose lines' shingle sets are similar enough."""
    one, two = (
        texts.select(F.col("node").alias(f"_{n}"), F.col("line").alias(f"line_{n}")) for n in "ab"
    )
    rows = pairs.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
    found = rows.select("a", "b", *[_windows(F.col(f"line_{n}")).alias(f"found_{n}") for n in "ab"])
    # Both drop what repeats.
    sizes = found.select(
        "a", "b", F.size(F.array_intersect("found_a", "found_b")).alias("both"),
        F.size(F.array_union("found_a", "found_b")).alias("either"),
    )
    # Stored, or the filter would be moved below, where it computes the sets again and again.
    sizes = stored(sizes, "line-overlaps")
    return sizes.filter(100 * F.col("both") >= PERCENT * F.col("either")).select("a", "b")


def _marks(texts: DataFrame) -> DataFrame:
    """``_node, size, bits_0, ...``: of each line the number of shingles and their parity bitmap,
    in which each shingle turns one bit over. Shingles are combined in each row, then in each task."""
    sets = texts.select("node", character_set(F.col("line")).alias("found"))
    sets = sets.select("node", "found", F.size("found").alias("size"))
    begins = F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(TOGETHER))).alias("begin")
    rows = sets.select("node", "found", "size", begins)
    # Behind the last shingle there is NULL, which turns nothing over.
    rows = rows.select("node", "size", *[F.get("found", F.col("begin") + j).alias(f"x{j}") for j in range(TOGETHER)])
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    bit = lambda x: F.call_function("shiftleft", one, F.shiftright(x, 8).bitwiseAND(F.lit(63)).cast("int"))
    names = [f"x{j}" for j in range(TOGETHER)]
    words = [F.col(x).bitwiseAND(F.lit(WORDS - 1)).alias(f"word_{x}") for x in names]
    rows = rows.select("node", "size", *words, *[bit(x).alias(f"bit_{x}") for x in names])

    def turned(k: int) -> Column:
        found = [F.when(F.col(f"word_{x}") == k, F.col(f"bit_{x}")).otherwise(none) for x in names]
        return F.bit_xor(reduce(Column.bitwiseXOR, found)).alias(f"bits_{k}")

    return rows.groupBy(F.col("node").alias("_node")).agg(F.max("size").alias("size"), *[turned(k) for k in range(WORDS)])


def _still_possible(shared: DataFrame, hung: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of one bucket but of different components ``hung`` that may be similar.

    In each bucket all lines meet those outside its largest component.
    """
    top = hung.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rooted = shared.select("band", "node").join(top, F.col("node") == F.col("_node"), "left")
    rooted = stored(rooted.select("band", "node", F.coalesce("_root", "node").alias("root")), "bucket-roots")
    counts = rooted.groupBy("band", "root").agg(F.count("*").alias("n"))
    several = counts.groupBy(F.col("band").alias("_band")).agg(
        F.sum("n").alias("lines"), F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")
    )
    several = several.filter(F.col("roots") > 1).drop("roots")
    rows = stored(rooted.join(several, F.col("band") == F.col("_band")).drop("_band"), "open-buckets")
    rows = rows.join(marks, F.col("node") == F.col("_node"))
    chunks = F.ceil(F.col("lines") / CHUNK).cast("int")
    columns = ["node", "root", "size", *[f"bits_{k}" for k in range(WORDS)]]
    rows = rows.select(
        "band", *columns, (F.col("root") == F.col("main")).alias("main"),
        F.pmod(F.xxhash64("node"), chunks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"),
    )
    one = rows.select("band", "own", "other", "main", *[F.col(c).alias(f"{c}_a") for c in columns])
    two = rows.filter(~F.col("main")).select(
        F.col("band").alias("_band"), F.col("own").alias("_other"), F.col("other").alias("_own"),
        *[F.col(c).alias(f"{c}_b") for c in columns],
    )
    met = (F.col("band") == F.col("_band")) & (F.col("own") == F.col("_own")) & (F.col("other") == F.col("_other"))
    met = met & (F.col("root_a") != F.col("root_b")) & (F.col("main") | (F.col("node_a") < F.col("node_b")))
    for condition in _possible():
        met = met & condition
    pairs = one.join(two, met)
    return pairs.select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    ).distinct()


def _links(shared: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, root`` of each component of the buckets' lines."""
    marks = stored(_marks(texts), "line-marks")
    hung = components(_similar(_left_possible(_to_first(shared), marks), texts), "a", "b")
    more = _similar(_still_possible(shared, hung, marks), texts)
    return components(hung.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more), "a", "b")


def first_places(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, copy, pos`` of the lines that stay: the first of each component."""
    raw = raw_lines(docs, id, text)
    place = F.struct("id", "copy", "pos").alias("place")
    lines = raw.select(place, normalised(F.col("raw")).alias("line"))
    nodes = lines.select(F.xxhash64("line").alias("node"), "place").groupBy("node").agg(F.min("place").alias("place"))
    nodes = stored(nodes, "lines")

    signed = signatures(lines.select(F.xxhash64("line").alias("node"), "line"))
    shared = stored(_buckets(signed), "buckets")
    # The line that most documents have is the likeliest to resemble the others.
    most = F.max_by("node", F.struct("n", "node")).alias("first")
    most = shared.groupBy(F.col("band").alias("_band")).agg(most)
    shared = shared.join(most, F.col("band") == F.col("_band")).select("band", "node", "first")
    shared = stored(shared, "bucket-firsts")

    wanted = shared.select(F.col("node").alias("_node")).distinct()
    wanted = nodes.join(wanted, F.col("node") == F.col("_node"), "left_semi").select("node", "place")
    texts = stored(_own_lines(docs, id, text, wanted), "line-texts")
    hung = _links(shared, texts)

    top = hung.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rooted = nodes.join(top, F.col("node") == F.col("_node"), "left")
    rooted = rooted.select("place", F.coalesce("_root", "node").alias("root"))
    return rooted.groupBy("root").agg(F.min("place").alias("place")).select("place.*")


def removed_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, copy, n_lines, n_removed, removed`` of each document with lines; ``removed``
    are the places of its lines that go, from 0."""
    kept = first_places(docs, id, text)
    own = named(docs, id=id, text=text)
    # Places of all lines that are not blank; only these and the kept ones move, once.
    full = lambda line, i: F.when(F.ltrim(line, F.lit(BLANKS)) != "", i)
    places = F.array_compact(F.transform(F.split("text", "\n"), full)).alias("places")
    rows = own.select("id", F.xxhash64("text").alias("copy"), places, F.lit(None).cast("int").alias("pos"))
    kept = kept.select("id", "copy", F.lit(None).cast("array<int>").alias("places"), "pos")
    # A document has no more kept places than lines; rows that repeat are combined in each task.
    rows = rows.unionByName(kept).groupBy("id", "copy").agg(
        F.first("places", ignorenulls=True).alias("places"), F.collect_list("pos").alias("stays")
    )
    rows = rows.select("id", "copy", F.size("places").alias("n_lines"), F.array_except("places", "stays").alias("removed"))
    rows = rows.filter(F.col("n_lines") > 0)
    return rows.select("id", "copy", "n_lines", F.size("removed").alias("n_removed"), "removed")


def dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """The documents without their repeated lines. A document of which no line stays is
    left out; ``n_chars``, where there is such a column, follows the text."""
    with scratch(docs.sparkSession):
        gone = removed_lines(docs, id, text).filter(F.col("n_removed") > 0)
        gone = stored(gone, "removed-lines", keep=True)
    names = {c: fresh(docs, f"_{c}") for c in ("id", "copy", "n_lines", "n_removed", "removed")}
    gone = gone.toDF(*[names[c] for c in ("id", "copy", "n_lines", "n_removed", "removed")])
    same = docs[id].eqNullSafe(gone[names["id"]])
    same = same & (F.xxhash64(docs[text]) == gone[names["copy"]])
    rows = docs.join(gone, same, "left")
    rows = rows.filter(F.col(names["removed"]).isNull() | (F.col(names["n_removed"]) < F.col(names["n_lines"])))
    removed = F.col(names["removed"])
    stays = F.filter(F.split(docs[text], "\n"), lambda line, i: ~F.array_contains(removed, i))
    short = F.when(removed.isNull(), docs[text]).otherwise(F.array_join(stays, "\n"))
    columns = {c: docs[c] for c in docs.columns}
    columns[text] = short.alias(text)
    if n_chars in columns:
        columns[n_chars] = F.when(removed.isNull(), docs[n_chars]).otherwise(
            F.length(short).cast(docs.schema[n_chars].dataType)
        ).alias(n_chars)
    return rows.select(*columns.values())
