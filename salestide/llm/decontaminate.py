"""Benchmark decontamination by template windows, in DataFrame functions only.

Words are canonicalised: case and outer punctuation go, numbers, names (capitalised inside
a sentence) and units (right after a number) become typed placeholders. Windows of eight
canonical words are hash-joined with those of the benchmark, so a question is found whose
numbers or names were exchanged. Three kinds of an item's window are looked up:

- the template, if it has ``LEAST_WORDS`` words that are no placeholders;
- the template with its names as plain words, which finds copies that lost their capitals;
- for windows with fewer words of their own, the plain words: they match word for word only.

Where windows of an item match in place, the exchanged values are compared both ways: one benchmark
value must always stand for one value of the document, and that one for no other. A document is
contaminated by an item if enough of the item's templates are found in it and the slots of the
longest stretch in line are consistent, or if enough of all its windows are there word for word.

The first pass looks up windows and keeps the ids of documents with a hit; the second reads
the texts of those alone. The benchmark's windows are stored first, so Spark knows their
size and broadcasts them only while that is below its own limit.

Defined results: NULL or empty texts and items have no words and no hits; an item of fewer
than ``LEAST_WORDS`` words is never found, one shorter than a window is one
window of its length; repeated items are items of their own; rows that share an id (or have
none) are judged as one document, window by window; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.rows import fresh, lower_ascii, named
from salestide.session import scratch, stored

WINDOW = 8
#: Words of an item, and of a template those that are no placeholders, at least.
LEAST_WORDS = 5
#: Share of an item's windows that must be found, and of its slots that agree.
COVERAGE = 0.5
AGREEING = 0.8

# Units that count as such right after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yards mi mile miles mg g kg lb lbs oz t ton tons "
    "ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents degrees mph"
).split()
EDGES = "\"'`.,;:!?()[]{}<>|*#&%$"
SENTENCE_END = "[.!?:]$"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _bare(word: Column) -> Column:
    """A word without outer punctuation, A-Z in lower case."""
    inner = F.btrim(word, F.lit(EDGES))
    # Of ASCII alone ``lower`` does the same, much faster.
    return F.when(F.octet_length(word) == F.length(word), F.lower(inner)).otherwise(lower_ascii(inner))


def _is_number(word: Column) -> Column:
    # Words are compared with characters: ``ascii`` makes a string of its own each time.
    signed = (word >= "$") & (word < ".") & word.rlike("^[+$-]+[0-9]")
    return (word < ":") & ((word >= "0") | signed)


def canonical(word: Column) -> Column:
    """Canonical form of each word of an array, which must be a column: a lambda that
    holds an expression would compute it for every word.

    Only words that begin with a digit, a sign or a capital need a closer look; of the
    others, a word is a unit only behind a number.
    """

    def form(w: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(word, i - 1))
        plain = _bare(w)
        capital = (w < "[") & (w >= "A") & before.isNotNull()
        inside = ~F.coalesce(before.rlike(SENTENCE_END), F.lit(True))
        behind_number = F.coalesce(_is_number(before), F.lit(False))
        return (
            F.when(_is_number(w), F.lit("<number>"))
            .when(capital & inside & w.rlike("^[A-Z][a-z]"), F.lit("<name>"))
            .when(behind_number & plain.isin(UNITS), F.lit("<unit>"))
            .otherwise(plain)
        )

    return F.transform(word, form)


def windows(codes: Column, width: int) -> Column:
    """Hashes of all windows of an array of word hashes."""
    count = F.size(codes) - (width - 1)
    starts = F.when(count > 0, F.sequence(F.lit(1), count))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.xxhash64(F.slice(codes, at, width)))


def _codes(forms: Column) -> Column:
    return F.transform(forms, lambda w: F.xxhash64(w))


PLACEHOLDERS = ("<number>", "<name>", "<unit>")


def _literal(forms: Column) -> Column:
    return F.size(F.filter(forms, lambda w: ~w.isin(*PLACEHOLDERS, "")))


def plain_windows(codes: Column, width: int | Column) -> Column:
    """As ``windows``, of hashes that no template has."""
    return F.transform(windows(codes, width), lambda code: F.xxhash64(code, F.lit("plain")))


def _all_windows(rows: DataFrame, widths: list[int]) -> DataFrame:
    """``id, code`` of all ``windows`` of ``codes`` and ``plain_windows`` of ``plain``.

    A row for each place, as Spark compiles that and not functions of arrays; the hash of an
    array is that of its elements one after another.
    """
    places = F.size("codes") - min(widths)
    rows = rows.select("id", "codes", "plain", F.explode(F.when(places >= 0, F.sequence(F.lit(0), places))).alias("at"))

    def window(codes: str, width: int) -> Column:
        inside = F.col(codes).isNotNull() & (F.col("at") + width <= F.size(codes))
        code = F.xxhash64(*[F.get(codes, F.col("at") + k) for k in range(width)])
        return F.when(inside, F.xxhash64(code, F.lit("plain")) if codes == "plain" else code)

    every = [window(codes, width) for width in widths for codes in ("codes", "plain")]
    made = rows.select("id", F.explode(F.array(*every)).alias("code"))
    return made.filter(F.col("code").isNotNull())


def _dense(codes: Column) -> Column:
    """Whether hashed forms hold so many placeholders that a window may lack words."""
    marks = [F.xxhash64(F.lit(mark)) for mark in PLACEHOLDERS]
    return F.size(F.filter(codes, lambda code: code.isin(*marks))) > WINDOW - LEAST_WORDS


def item_windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item, place, width, code, usable, total, total_usable, words, forms`` for every window
    and kind of code; ``usable`` says whether it has a template."""
    own = items.select(
        F.monotonically_increasing_id().alias("row"),
        items[item].alias("item"),
        words(items[text]).alias("words"),
    )
    own = stored(own, "items").withColumn("forms", canonical(F.col("words")))
    width = F.least(F.size("forms"), F.lit(WINDOW)).alias("width")
    rows = own.select("*", width).filter(F.col("width") >= LEAST_WORDS)
    places = F.sequence(F.lit(0), F.size("forms") - F.col("width"))
    rows = rows.select("*", F.explode(places).alias("place"))
    part = [F.slice(c, F.col("place") + 1, F.col("width")).alias(c) for c in ("words", "forms")]
    rows = rows.select("row", "item", "place", "width", *part)
    plain = _plain(F.col("words"))
    unnamed = F.zip_with("forms", plain, lambda form, word: F.when(form == "<name>", word).otherwise(form))
    rows = rows.withColumns({"plain": plain, "unnamed": unnamed, "usable": _literal(F.col("forms")) >= LEAST_WORDS})
    totals = rows.groupBy("row").agg(F.count("*").alias("total"), F.count_if("usable").alias("total_usable"))
    template = F.when(F.col("usable"), F.xxhash64(_codes(F.col("forms"))))
    named = F.array_contains("forms", "<name>") & (_literal(F.col("unnamed")) >= LEAST_WORDS)
    lowered = F.when(named, F.xxhash64(_codes(F.col("unnamed"))))
    verbatim = F.when(~F.col("usable"), F.xxhash64(F.xxhash64(_codes(F.col("plain"))), F.lit("plain")))
    kinds = F.array_distinct(F.array_compact(F.array(template, lowered, verbatim)))
    rows = rows.select("row", "item", "place", "width", "words", "forms", "usable", F.explode(kinds).alias("code"))
    return rows.join(totals, "row")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id, item, n_windows, coverage, verbatim, agreeing`` of every contaminated pair.

    ``coverage`` is the larger share of the item's templates and of its windows word for word.
    """
    bench = stored(item_windows(items, item, item_text), "item-windows")
    widths = [row["width"] for row in bench.select("width").distinct().collect()]
    own = named(docs, id=id, text=text)
    if not widths:
        widths = [WINDOW]

    # Which documents have a hit at all.
    codes = own.select("id", words(F.col("text")).alias("w"))
    codes = codes.select("id", "w", _codes(canonical(F.col("w"))).alias("codes"))
    codes = codes.select("id", "codes", F.when(_dense(F.col("codes")), _codes(_plain(F.col("w")))).alias("plain"))
    looked_up = _all_windows(codes, sorted(widths))
    keys = stored(bench.select(F.col("code").alias("_code")).distinct(), "item-codes")
    hits = looked_up.join(keys, F.col("code") == F.col("_code"), "left_semi")
    ids = stored(hits.select("id").distinct(), "hit-documents").select(F.col("id").alias("_id"))

    # Where, for those documents.
    found = own.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    found = found.select("id", F.xxhash64("text").alias("copy"), words(F.col("text")).alias("w"))
    found = found.dropDuplicates(["id", "copy"]).withColumn("f", canonical(F.col("w")))
    found = stored(found, "hit-texts")
    found = found.select("id", "copy", "w", _codes(F.col("f")).alias("codes"), _codes(_plain(F.col("w"))).alias("plain"))
    at = [
        found.select("id", "copy", F.posexplode(made(F.col(codes), width)), F.lit(width).alias("n"), "w")
        .select("id", "copy", F.col("pos").alias("at"), F.col("col").alias("code"), "n",
                F.slice("w", F.col("pos") + 1, width).alias("said"))
        for width in sorted(widths)
        for made, codes in ((windows, "codes"), (plain_windows, "plain"))
    ]
    rows = at[0]
    for more in at[1:]:
        rows = rows.unionByName(more)
    same = (rows["code"] == bench["code"]) & (rows["n"] == bench["width"])
    matched = rows.join(bench, same).select(
        "id", "copy", "row", "item", "total", "total_usable", "usable", "place",
        (F.col("at") - F.col("place")).alias("line"), "said", "words", "forms",
        (_plain(F.col("said")) == _plain(F.col("words"))).alias("verbatim"),
    )
    matched = stored(matched, "window-hits")
    line = ["id", "copy", "row", "line"]
    in_line = matched.groupBy(*line).agg(
        F.first("item").alias("item"),
        F.first("total").alias("total"),
        F.first("total_usable").alias("total_usable"),
        F.count_distinct("place").alias("n_windows"),
        F.min("verbatim").alias("verbatim"),
    )
    slots = matched.select(*line, F.explode(_slots()).alias("slot")).select(*line, "slot.*")
    # Pairs of values, then for each value of either side whether it has one partner alone.
    slots = slots.distinct()
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).alias("value")) for k, c in enumerate(("asked", "said"))])
    values = slots.select(*line, "kind", F.explode(sides).alias("own")).groupBy(*line, "kind", "own")
    alone = values.agg((F.count("*") == 1).cast("double").alias("one"))
    each = [F.avg(F.when(F.col("own.side") == k, F.col("one"))) for k in (0, 1)]
    agreeing = alone.groupBy(*line).agg(F.least(*each).alias("agreeing"))
    agreeing = agreeing.select(*[F.col(c).alias(f"_{c}") for c in line], "agreeing")
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in line]
    lines = in_line.join(agreeing, equal, "left").withColumn(
        "agreeing", F.coalesce("agreeing", F.lit(1.0))
    )
    # An item that was cut in two by a word too many lies on two lines.
    whole = ["id", "copy", "row"]
    best = F.max_by(F.struct("verbatim", "agreeing"), "n_windows").alias("best")
    kept = [F.first(c).alias(c) for c in ("item", "total", "total_usable")]
    lines = lines.groupBy(*whole).agg(best, *kept)
    places = matched.groupBy(*[F.col(c).alias(f"_{c}") for c in whole])
    places = places.agg(
        F.count_distinct("place").alias("n_windows"),
        F.count_distinct(F.when(F.col("usable"), F.col("place"))).alias("n_usable"),
        F.count_distinct(F.when(F.col("verbatim"), F.col("place"))).alias("n_verbatim"),
    )
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in whole]
    templates = F.when(F.col("total_usable") > 0, F.col("n_usable") / F.col("total_usable"))
    exact = F.col("n_verbatim") / F.col("total")
    made = lines.join(places, equal).withColumns({"coverage": F.greatest(templates, exact), "exact": exact})
    same_slots = (F.col("coverage") >= COVERAGE) & (F.col("best.agreeing") >= AGREEING)
    made = made.filter(same_slots | (F.col("exact") >= COVERAGE))
    made = made.select("id", "row", "item", "n_windows", "coverage", "best.*")
    most = F.max_by(F.struct("n_windows", "coverage", "verbatim", "agreeing"), "coverage")
    made = made.groupBy("id", "row").agg(F.first("item").alias("item"), most.alias("best"))
    return made.select("id", "item", "best.*")


def _plain(said: Column) -> Column:
    return F.transform(said, _bare)


def _slots() -> Column:
    """Placeholders of a matched window: their kind, the item's value, the document's."""
    said, asked, forms = (F.col(c) for c in ("said", "words", "forms"))
    plain_said, plain_asked = _plain(said), _plain(asked)
    all_slots = F.transform(
        forms,
        lambda kind, i: F.struct(
            kind.alias("kind"),
            F.get(plain_asked, i).alias("asked"),
            F.get(plain_said, i).alias("said"),
        ),
    )
    return F.filter(all_slots, lambda s: s["kind"].isin(*PLACEHOLDERS))


def keep_clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", **names: str) -> DataFrame:
    """The documents that no item contaminates, with their columns."""
    key = fresh(docs, "_id")
    with scratch(docs.sparkSession):
        bad = contaminated(docs, items, id=id, **names).select(F.col("id").alias(key)).distinct()
        bad = stored(bad, "contaminated", keep=True)
    return docs.join(bad, docs[id].eqNullSafe(bad[key]), "left_anti")
