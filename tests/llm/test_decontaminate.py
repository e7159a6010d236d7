from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from salestide.llm import decontaminate, queries
from tests.llm import plain

FILL = [f"filler{i}" for i in range(400)]
ITEM = "A train leaves Paris at 8 and runs 120 km to reach Lyon, then 8 more hours pass until it stops."
OTHER = "How many apples has the farmer left after selling twelve baskets of nine apples each to Anna?"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, OTHER), (3, None), (4, "too short"), (5, ""), (6, "just five plain words here")]
    return spark.createDataFrame(rows, "item_id long, text string")


def _pairs(docs, items):
    return {(r.id, r.item): r for r in decontaminate.contaminated(docs, items).collect()}


def _around(text):
    return " ".join(FILL[:60]) + ". " + text + " " + " ".join(FILL[60:150])


def test_exact_and_changed_questions_are_found(make_docs, items):
    changed = ITEM.replace("8", "9").replace("120 km", "75 miles").replace("Paris", "Rome").replace("Lyon", "Turin")
    docs = make_docs([
        (1, _around(ITEM), "a"), (2, _around(changed), "a"), (3, _around(OTHER.upper().lower()), "a"),
        (4, " ".join(FILL), "a"), (5, _around(" ".join(ITEM.split()[:9])), "a"),
        (6, _around("here we say just five plain words here again"), "a"),
        (7, _around(ITEM.replace("runs", "quietly runs")), "a"),
    ])
    got = _pairs(docs, items)
    # Two windows of an item are not enough; a word too many does no harm.
    assert set(got) == {(1, 1), (2, 1), (3, 2), (6, 6), (7, 1)}
    assert got[1, 1].verbatim and not got[2, 1].verbatim
    assert got[1, 1].coverage > 0.9 and got[2, 1].agreeing == 1.0


def test_slots_that_disagree_are_no_question(make_docs, spark):
    item = "box 5 holds red marbles and box 5 also holds blue marbles while box 5 gives them all away"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    good, bad = item.replace("5", "7"), item.replace("5", "7", 1).replace("5", "6", 1).replace("5", "3", 1)
    docs = make_docs([(1, _around(good), "a"), (2, _around(bad), "a")])
    assert set(_pairs(docs, bench)) == {(1, 1)}


def test_the_small_table_holds_its_passages(spark, small):
    items = spark.read.parquet(f"{plain.FOLDER}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.benchmark_leaks(spark, plain.FOLDER).collect()}

    def said(text):
        return [re.sub(r"^[^\w]+|[^\w]+$", "", w).lower() for w in plain.words(text)]

    held = set()
    for row in small[1]:
        whole = f" {' '.join(said(row.text))} "
        held |= {(row.doc_id, i.item_id) for i in items if f" {' '.join(said(i.text))} " in whole}
    assert held and held <= got
    # Whatever else is found shares about half of the item's eight-word windows.
    texts, asked = {r.doc_id: said(r.text) for r in small[1]}, {i.item_id: said(i.text) for i in items}
    for doc, item in got - held:
        windows = [tuple(asked[item][k : k + 8]) for k in range(len(asked[item]) - 7)]
        own = {tuple(texts[doc][k : k + 8]) for k in range(len(texts[doc]) - 7)}
        assert sum(w in own for w in windows) >= 0.4 * len(windows)


def test_edges(make_docs, items, spark):
    rows = [(None, _around(ITEM), None), (1, None, None), (2, "", "a"), (3, _around(ITEM), "a"), (3, _around(ITEM), "a")]
    rows += [(4, " ".join(FILL * 100) + " " + ITEM, "a"), (5, " ".join(FILL), "b")]
    docs = make_docs(rows, clashing=True)
    assert {i for i, _ in _pairs(docs, items)} == {None, 3, 4}
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).collect() == []
    assert decontaminate.keep_clean(docs, none).count() == len(rows)
    assert decontaminate.contaminated(make_docs([]), items).collect() == []


def test_the_main_path_has_no_python(make_docs, items):
    plan = decontaminate.contaminated(make_docs([(1, ITEM, "a")]), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


NUMBERS = "At 8 o'clock 3 buses and 12 cars carry 40 and 7 people past 5 gates and 9 doors"
NAMES = "Why did Anna meet Bert and Carl near Dover before Emma and Frank came along with Gina to the old harbour?"


def test_items_dense_in_numbers_and_copies_without_capitals(make_docs, spark):
    bench = spark.createDataFrame([(1, NUMBERS), (2, NAMES), (3, "2 3 5 7 11 13 17 19 23")], "item_id long, text string")
    other = re.sub("[0-9]+", lambda m: str(int(m[0]) + 1), NUMBERS)
    docs = make_docs([
        (1, _around(NUMBERS), "a"), (2, _around(NAMES.lower()), "a"), (3, _around(NUMBERS.lower()), "a"),
        (4, _around(NAMES.replace("Anna", "Hugo").replace("Gina", "Ida")), "a"),
        # Numbers in a row like any other table of them, and the item's own row.
        (5, _around("1 2 3 4 5 6 7 8 9 10 11 12"), "a"), (6, _around("1 2 3 5 7 11 13 17 19 23 29"), "a"),
        (7, _around(other), "a"),
    ])
    got = set(_pairs(docs, bench))
    assert {(1, 1), (2, 2), (3, 1), (4, 2), (6, 3)} <= got
    assert not {(5, 3), (5, 1), (6, 1)} & got


def test_values_that_became_one_are_no_question(make_docs, spark):
    item = "first Anna gives Bert 3 red apples while Carl pays 5 coins for 7 pears and Dora takes 9 plums home"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    one = re.sub("[0-9]", "4", re.sub("Anna|Bert|Carl|Dora", "Emma", item))
    other = item.replace("Anna", "Emma").replace("3", "4")
    docs = make_docs([(1, _around(one), "a"), (2, _around(other), "a")])
    assert set(_pairs(docs, bench)) == {(2, 1)}


def _forms(found):
    def edge(w):
        return w.strip(decontaminate.EDGES).translate(plain.LOWER)

    forms, number = [], lambda w: bool(re.match("[0-9]|[+$-]+[0-9]", w))
    for i, w in enumerate(found):
        if number(w):
            forms.append("<number>")
        elif i and re.match("[A-Z][a-z]", w) and not re.search("[.!?:]$", found[i - 1]):
            forms.append("<name>")
        elif i and number(found[i - 1]) and edge(w) in decontaminate.UNITS:
            forms.append("<unit>")
        else:
            forms.append(edge(w))
    return forms, [edge(w) for w in found]


def judged(text, item):
    """The coverage of an item in a text if it is contaminated: every window against every window."""
    own, asked = plain.words(text), plain.words(item)
    width = min(8, len(asked))
    if width < 5:
        return None
    (forms, said), (templates, wanted) = _forms(own), _forms(asked)
    marks = set(decontaminate.PLACEHOLDERS) | {""}
    lines, usable, usable_hit, exact_hit = {}, set(), set(), set()
    windows = {}
    for at in range(len(own) - width + 1):
        windows.setdefault(tuple(forms[at : at + width]), []).append(at)
    plains = {}
    for at in range(len(own) - width + 1):
        plains.setdefault(tuple(said[at : at + width]), []).append(at)
    total = len(asked) - width + 1
    for place in range(total):
        template = templates[place : place + width]
        literal = sum(w not in marks for w in template)
        unnamed = [w if t == "<name>" else t for t, w in zip(template, wanted[place : place + width])]
        hits = set()
        if literal >= 5:
            usable.add(place)
            hits |= set(windows.get(tuple(template), []))
        if "<name>" in template and sum(w not in marks for w in unnamed) >= 5:
            hits |= set(windows.get(tuple(unnamed), []))
        if literal < 5:
            hits |= set(plains.get(tuple(wanted[place : place + width]), []))
        for at in hits:
            lines.setdefault(at - place, []).append((place, at))
            usable_hit |= {place} & usable
            if said[at : at + width] == wanted[place : place + width]:
                exact_hit.add(place)
    if not lines:
        return None
    most = max(len(x) for x in lines.values())
    agreeing = []
    for hits in lines.values():
        slots = {
            (templates[place + k], wanted[place + k], said[at + k])
            for place, at in hits for k in range(width) if templates[place + k] in decontaminate.PLACEHOLDERS
        }
        sides = [[(k, v) for k, v, *_ in slots], [(k, v) for k, _, v in slots]]
        shares = [sum(side.count(x) == 1 for x in set(side)) / len(set(side)) if side else 1.0 for side in sides]
        if len(hits) == most:
            agreeing.append(min(shares))
    exact = len(exact_hit) / total
    coverage = max(exact, len(usable_hit) / len(usable) if usable else 0)
    if exact >= 0.5 or coverage >= 0.5 and max(agreeing) >= 0.8:
        return round(coverage, 9)
    return None


def test_the_small_table_against_all_windows(spark, small):
    items = spark.read.parquet(f"{plain.FOLDER}/benchmark.parquet").collect()
    want = {(r.doc_id, i.item_id): judged(r.text, i.text) for r in small[1] for i in items}
    got = {(r.doc_id, r.item_id): round(r.coverage, 9) for r in queries.benchmark_leaks(spark, plain.FOLDER).collect()}
    assert got == {pair: c for pair, c in want.items() if c is not None}


def test_looked_up_windows_are_those_of_the_benchmark(spark):
    """The compiled lookup gives the codes of the array functions, for several widths and no word too few."""
    chance = random.Random(4)
    rows = [(i, [chance.randrange(9) for _ in range(n)], None if i % 3 else [chance.randrange(9) for _ in range(n)])
            for i, n in enumerate([0, 1, 4, 5, 6, 7, 8, 9, 30, 0, 5, 8, 40])]
    frame = spark.createDataFrame(rows, "id long, codes array<long>, plain array<long>")
    widths, none = [5, 8], F.array().cast("array<long>")
    made = [decontaminate.windows(F.col("codes"), w) for w in widths]
    made += [F.coalesce(decontaminate.plain_windows(F.col("plain"), w), none) for w in widths]
    want = frame.select("id", F.explode(F.concat(*made)).alias("code"))
    got = decontaminate._all_windows(frame, widths)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_numbers_and_capitals_by_first_character(spark):
    said = ["0", "9a", ":", "/", "+5", "-", "$-3", "%5", "'5", ".5", "A", "Zed", "Ab", "[x", "@", "é", "É", "a", "Éa", "(AB)", "\"Ém,\""]
    words = [w for x in said for w in ("so", x)]
    got = spark.createDataFrame([(words,)], "w array<string>").select(decontaminate.canonical(F.col("w")).alias("f")).first().f
    edges = "\"'`.,;:!?()[]{}<>|*#&%$"

    def form(x):
        if re.match("[+$-]*[0-9]", x):
            return "<number>"
        return "<name>" if re.match("[A-Z][a-z]", x) else x.strip(edges).translate(plain.LOWER)

    assert got[1::2] == [form(x) for x in said]
