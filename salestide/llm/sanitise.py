"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

E-mail and IP addresses, card and phone numbers are found by pattern and checked. They are the
protected entities, and so are the groups they belong to: the host of an e-mail address, the network of
an IP address, the issuer of a card, the area of a phone. The corpus tells which other terms give
an entity away. With ``n`` counting different texts of ``N``, a term's share is shrunk towards
what any text has, with the weight of sqrt(N) texts:

    shrunk(x | term) = (n(x, term) + sqrt(N) * P(x)) / (n(term) + sqrt(N))
    disclosure(term, x) = log(shrunk(x | term) / P(x)) / -log P(x)

which is 0 for a term that says nothing and near 1 for one that occurs in many texts and with this
entity only. A single text together is never more than 0.5: what a value that occurs once can't show,
its group may. Terms above ``REMOVE`` are removed from the texts that hold the entity, those above
``GENERALISE`` generalised: replaced by the kind of what they give away.

All documents are counted. Counts are combined in each task before they are shuffled; only
documents that hold a protected value are stored and joined, and the patterns run over each text once.
Copies of a text that holds a value count once.

Defined results: NULL is empty and has no spans; a span that fails its check is dropped and
nothing is tried in its place; a term inside a protected value is not a span of its own; rows
that repeat id and text have the same spans; NULL is an id of its own; no documents give no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.rows import lower_ascii, named
from salestide.llm.spans import spans
from salestide.session import stored

# Kinds in their order, with patterns that find what the plain ones find
# ([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on). They begin only where a
# run begins or the last match ended, and do not go back, so long runs cost no more.
KINDS = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
IP = f"^{PART}(?:\\.{PART}){{3}}$"
TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]{3,}"
NOT_TERM = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: Above one half, which a single text reaches, as far as disclosures go.
GENERALISE, REMOVE = 0.55, 0.75


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d: d.cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(found, F.lit(IP))
    if kind == "card":
        digits = _digits(found)
        fits = F.length(digits).between(14, 19)
        return F.when(fits, luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def with_spans(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base``: start, order of the kind, end, kind and text of each span, sorted."""

    def of_kind(order: int, kind: str) -> Column:
        found = F.filter(spans(F.col(text), KINDS[kind]), lambda s: _valid(kind, s["found"]))
        return F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(order).alias("order"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                s["found"].alias("found"),
            ),
        )

    kinds = [of_kind(order, kind) for order, kind in enumerate(KINDS)]
    return rows.withColumn("base", F.sort_array(F.concat(*kinds)))


def _terms(text: Column) -> Column:
    """The distinct terms of a text: words of letters, A-Z in lower case, three or more."""
    words = F.array_distinct(F.split(lower_ascii(text), NOT_TERM))
    return F.filter(words, lambda w: F.length(w) >= 3)


def _group(kind: Column, found: Column) -> Column:
    """What a value belongs to: host, network of two numbers, six digits, five digits."""
    host = F.lower(F.regexp_extract(found, "@(.*)$", 1))
    network = F.regexp_extract(found, "^0*([0-9]+[.])0*([0-9]+)", 0)
    digits = F.when(kind == "card", F.substring(_digits(found), 1, 6)).otherwise(F.substring(_digits(found), 1, 5))
    return F.when(kind == "email", host).when(kind == "ip", network).otherwise(digits)


def entities(base: Column) -> Column:
    """The distinct values of a text's spans and their groups, as strings that tell them apart."""
    of = lambda level, s, said: F.concat_ws(":", F.lit(level), s["kind"], said)
    values = F.transform(base, lambda s: of("value", s, s["found"]))
    groups = F.transform(base, lambda s: of("group", s, _group(s["kind"], s["found"])))
    return F.array_distinct(F.concat(values, groups))


def disclosure(both: Column, term: Column, entity: Column, total: Column) -> Column:
    """How much of an entity a term discloses, from numbers of texts."""
    chance, weight = entity / total, F.sqrt(total)
    shrunk = (both + weight * chance) / (term + weight)
    return F.when(entity < total, F.log(shrunk / chance) / -F.log(chance)).otherwise(0.0)


def revealing(rows: DataFrame, private: DataFrame) -> DataFrame:
    """``entity, term, disclosure`` for terms above the lower threshold.

    ``rows``: ``text`` of all documents; ``private``: ``copy, text, base`` of those with
    protected values.
    """
    copies = private.groupBy("copy").agg(F.count("*").alias("rows"), F.first("base").alias("base"), F.first("text").alias("text"))
    copies = stored(copies, "private-texts")
    again = copies.agg(F.sum(F.col("rows") - 1)).first()[0] or 0
    total = F.lit(float(max(rows.count() - again, 1)))
    held = copies.select("copy", F.explode(entities(F.col("base"))).alias("entity"))
    # A single text never discloses enough: only entities of several texts go on.
    several = held.groupBy("entity").agg(F.count("*").alias("entity_texts")).filter(F.col("entity_texts") > 1)
    held = stored(held.join(several, "entity"), "repeated-entities")
    texts = copies.select(F.col("copy").alias("_copy"), "rows", F.explode(_terms(F.col("text"))).alias("term"))
    beside = held.join(texts, F.col("copy") == F.col("_copy"))
    pairs = beside.groupBy("entity", "term").agg(F.count("*").alias("both"), F.first("entity_texts").alias("entity_texts"))
    pairs = stored(pairs.filter(F.col("both") > 1), "entity-terms")
    # An inner join: a semi join would be moved below the counting, and shuffle all terms.
    everywhere = rows.select(F.explode(_terms(F.col("text"))).alias("term"), F.lit(1).alias("n"))
    repeated = texts.filter(F.col("rows") > 1).select("term", (1 - F.col("rows")).cast("int").alias("n"))
    counts = everywhere.unionByName(repeated).groupBy("term").agg(F.sum("n").alias("term_texts"))
    known = pairs.join(counts, "term")
    told = disclosure(F.col("both"), F.col("term_texts"), F.col("entity_texts"), total)
    known = known.select("entity", "term", told.alias("disclosure"))
    return known.filter(F.col("disclosure") >= GENERALISE)


def _term_spans(rows: DataFrame) -> DataFrame:
    """Adds ``told``: spans of the row's ``terms`` that no base span overlaps."""
    some = F.array_join(F.map_keys("terms"), "|")
    edge = "\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F"
    pattern = F.concat(F.lit(f"(?<![^{edge}])(?:"), some, F.lit(f")(?![^{edge}])"))
    rows = rows.withColumn("low", lower_ascii(F.col("text"))).withColumn("pattern", pattern)
    rows = rows.withColumn("places", F.when(F.size("terms") > 0, spans(F.col("low"), F.col("pattern"))))
    places = F.coalesce("places", F.array().cast("array<struct<start:int,end:int,found:string>>"))
    alone = F.filter(
        places,
        lambda p: ~F.exists("base", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])),
    )

    def span(p: Column) -> Column:
        told = F.element_at(F.col("terms"), p["found"])
        return F.struct(
            p["start"].alias("start"),
            F.lit(len(KINDS)).alias("order"),
            p["end"].alias("end"),
            F.when(told["disclosure"] >= REMOVE, "removed").otherwise(told["kind"]).alias("kind"),
            p["found"].alias("found"),
        )

    return rows.withColumn("told", F.transform(alone, span)).drop("low", "pattern", "places")


def find(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text, base, all``: the protected spans, and those with the revealing terms'."""
    rows = named(docs, id=id, text=text)
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text"))
    marked = with_spans(rows)
    private = marked.filter(F.size("base") > 0).withColumn("copy", F.xxhash64("text"))
    private = stored(private, "private")
    told = revealing(rows.select("text"), private)
    held = private.select("copy", F.explode(entities(F.col("base"))).alias("_entity")).distinct()
    terms = held.join(told, F.col("_entity") == F.col("entity"))
    most = F.struct("disclosure", F.element_at(F.split("entity", ":"), 2).alias("kind"))
    terms = terms.groupBy("copy", "term").agg(F.max(most).alias("told"))
    terms = terms.groupBy(F.col("copy").alias("_copy")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "told"))).alias("terms")
    )
    joined = private.join(terms, F.col("copy") == F.col("_copy"), "left")
    none = F.create_map().cast("map<string,struct<disclosure:double,kind:string>>")
    joined = joined.withColumn("terms", F.coalesce("terms", none))
    joined = _term_spans(joined)
    everything = F.sort_array(F.concat("base", "told")).alias("all")
    # The others, without a second look for the patterns.
    known = private.select(F.col("id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_copy"))
    nothing = F.array().cast(joined.schema["base"].dataType)
    clean = rows.join(known, same, "left_anti").select("id", "text", nothing.alias("base"), nothing.alias("all"))
    return clean.unionByName(joined.select("id", "text", "base", everything))


def written(spans_column: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined; a term's kind is ``term``."""
    kind = lambda s: F.when(s["order"] < len(KINDS), s["kind"]).otherwise("term")
    return F.array_join(
        F.transform(spans_column, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ","
    )


def sanitised(found: DataFrame) -> DataFrame:
    """``id, text`` with placeholders for spans; removed terms leave nothing behind.

    Where two spans overlap, the first one stands for both.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def replace(state: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        term = s["order"] == len(KINDS)
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.when(term, " TERM").otherwise(""), F.lit("]"))
        mark = F.when(s["kind"] == "removed", "").otherwise(mark)
        more = F.struct(s["end"].alias("at"), F.concat(state["text"], between, mark).alias("text"))
        longer = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["text"].alias("text"))
        return F.when(s["start"] >= state["at"], more).otherwise(longer)

    def rest(state: Column) -> Column:
        return F.concat(state["text"], F.substring(F.col("text"), state["at"] + 1, F.length("text")))

    return found.select("id", F.aggregate("all", start, replace, rest).alias("text"))
