from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salestide.llm import queries, sanitise
from tests.llm import plain


def _digests(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = rows.select("id", F.coalesce("text", F.lit("")).alias("text"))
    made = sanitise.with_spans(rows).select(
        "id", F.sha2(sanitise.written("base"), 256).alias("sha"), F.transform("base", lambda s: s["kind"]).alias("kinds")
    )
    return {r.id: (*[r.kinds.count(k) for k in plain.PATTERNS], r.sha) for r in made.collect()}


TEXTS = [
    None, "", "a@b.c", "x a@b.c_x@y.z. b@c", "a@b.c.@d.e", ".@.a a@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255",
    "0.0.0.0 00.000.0.10 256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111111", "+1 (017) 555-7713", "+1++12345678901 +(1)",
    "é🙂 +44 20 7946 0958, mail: é.a@b.co 10.0.0.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9", "4111 1111  1111 1111 0",
    "9" * 20_000, "a" * 100_000, "a." * 30_000 + "@b.c", "1.2." * 20_000, "1 " * 20_000, "+1" + " " * 50_000,
    "a@" + "b." * 9_000 + "c", "4111111111111111@b.c +4111111111111111",
]


def test_base_spans_on_edges(spark):
    got = _digests(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        assert got[i] == plain.personal(text), text and text[:60]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aZ9014@.+- ()_%é\n", max_size=60), min_size=40, max_size=60))
def test_base_spans_on_random_texts(spark, texts):
    assert _digests(spark, texts) == {i: plain.personal(t) for i, t in enumerate(texts)}


def test_the_small_table(spark, small):
    made = {r.doc_id: r for r in queries.personal_data(spark, plain.FOLDER).collect()}
    assert len(made) == len(small[1])
    for row in small[1]:
        r = made[row.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == plain.personal(row.text)


@pytest.fixture(scope="module")
def corpus(make_docs):
    """Zanzibar occurs with one address only, harbour with it and elsewhere."""
    rows = [(i, f"mail sam@corp.example about zanzibar harbour case number{i} now", "a") for i in range(6)]
    rows += [(100 + i, f"the harbour was quiet on day number{i + 50} and all slept", "a") for i in range(60)]
    rows += [(300 + i, "one text of a copy with rare wording bob@corp.example", "a") for i in range(8)]
    return make_docs([*rows, (None, None, None), (400, "", "a")], clashing=True)


def brute_disclosures(rows):
    """By entity and term, from whole texts; copies of a text with a value count once."""
    def group(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "email":
            return found.split("@", 1)[1].lower()
        return ".".join(str(found).split(".")[:2]) if kind == "ip" else digits[: 6 if kind == "card" else 5]

    texts = [t or "" for _, t, *_ in rows]
    held = {t: {(k, m) for k, p in plain.PATTERNS.items() for m in (x.group() for x in re.finditer(p, t)) if plain.valid(k, m)} for t in texts}
    once = sorted({t for t in texts if held[t]}) + [t for t in texts if not held[t]]
    terms = {t: {w for w in re.split("[\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(plain.LOWER)) if len(w) > 2} for t in once}
    total, weight = len(once), math.sqrt(len(once))
    n_term, n_entity, both = Counter(), Counter(), Counter()
    for t in once:
        n_term.update(terms[t])
        own = {f"value:{k}:{v}" for k, v in held[t]} | {f"group:{k}:{group(k, v)}" for k, v in held[t]}
        n_entity.update(own)
        both.update((e, w) for e in own for w in terms[t])
    found = {}
    for (e, w), n in both.items():
        p = n_entity[e] / total
        told = math.log((n + weight * p) / (n_term[w] + weight) / p) / -math.log(p) if p < 1 else 0
        if told >= sanitise.GENERALISE:
            assert n > 1  # a single text never discloses enough
            found[e, w] = told
    return found


def test_disclosures_against_all_texts(spark, make_docs, small, corpus):
    for docs in (corpus, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = docs.select(docs.columns[0], "text").withColumn("text", F.coalesce("text", F.lit("")))
        private = sanitise.with_spans(rows).filter(F.size("base") > 0).withColumn("copy", F.xxhash64("text"))
        got = {(r.entity, r.term): r.disclosure for r in sanitise.revealing(rows.select("text"), private).collect()}
        want = brute_disclosures([tuple(r) for r in rows.collect()])
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_revealing_terms_become_spans(corpus):
    found = sanitise.find(corpus)
    made = {r.id: r for r in found.select("id", sanitise.written("all").alias("spans"), "all").collect()}
    assert len(made) == 76 and made[None].spans == "" and made[100].spans == ""
    assert {"email:5:21", "term:28:36"} <= set(made[0].spans.split(","))
    terms = {s.found for s in made[0].all if s.order == len(sanitise.KINDS)}
    assert "zanzibar" in terms and "harbour" not in terms and "number0" not in terms
    # Copies of one text do not make its words revealing.
    assert all(s.kind == "email" for s in made[300].all)


def test_values_that_occur_once_are_given_away_by_their_group(make_docs):
    rows = [(i, f"write to user{i}@clinic{i % 2}.example from {'lakeside' if i % 2 else 'hilltop'} ward{i}", "a") for i in range(40)]
    rows += [(100 + i, f"some text about other things number{i} from somewhere", "a") for i in range(400)]
    made = {r.id: r for r in sanitise.find(make_docs(rows)).collect()}
    terms = [{s.found for s in made[i]["all"] if s.order == len(sanitise.KINDS)} for i in range(40)]
    assert all(("lakeside" if i % 2 else "hilltop") in terms[i] for i in range(40))
    assert all("from" not in t and f"ward{i}" not in t for i, t in enumerate(terms))


def test_sanitised_texts(corpus):
    made = {r.id: r.text for r in sanitise.sanitised(sanitise.find(corpus)).collect()}
    assert "sam@" not in made[0] and "[EMAIL]" in made[0] and "zanzibar" not in made[0]
    assert "harbour" in made[0] and made[100].startswith("the harbour was quiet") and made[400] == ""


def test_no_documents_and_no_python(make_docs, corpus):
    assert sanitise.find(make_docs([])).collect() == []
    assert "Python" not in sanitise.find(corpus)._jdf.queryExecution().toString()
