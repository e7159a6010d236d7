from __future__ import annotations

import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salestide import session
from salestide.llm import line_dedup, queries
from tests.llm import plain


def _normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(plain.LOWER)).strip(" ")


def _sets(lines):
    return [{line[i : i + 8] for i in range(max(1, len(line) - 7))} for line in lines]


def removed(rows):
    """Places of removed lines by document, with all pairs compared."""
    places = [
        ((doc, pos), _normal(line))
        for doc, text, *_ in rows
        for pos, line in enumerate((text or "").split("\n"))
        if _normal(line)
    ]
    lines = sorted({line for _, line in places})
    top = dict(zip(lines, plain.classes(len(lines), plain.similar(_sets(lines), 80))))
    seen, gone = set(), defaultdict(list)
    for (doc, pos), line in sorted(places):
        if top[line] in seen:
            gone[doc].append(pos)
        seen.add(top[line])
    return gone, places


@pytest.mark.parametrize("folder", [plain.FOLDER, "/root/testdata/sf0.01"])
def test_the_tables_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want, places = removed([tuple(r) for r in docs.collect()])
    got = {r.doc_id: r.removed for r in queries.fuzzy_lines(spark, folder).collect()}
    exact, first = defaultdict(set), {}
    for (doc, pos), line in sorted(places):
        if line in first:
            exact[doc].add(pos)
        first.setdefault(line, doc)
    fuzzy = found = 0
    for doc, lines in got.items():
        # Equal lines always go, and nothing goes that no pair allows.
        assert exact[doc] <= set(lines) <= set(want[doc])
        fuzzy += len(set(want[doc]) - exact[doc])
        found += len(set(lines) - exact[doc])
    # Of the lines that only resemble another one nearly all are found.
    assert fuzzy >= 30 and found >= 0.97 * fuzzy


def test_a_large_group_of_similar_lines_becomes_one(make_docs):
    base = "the quick brown fox jumps over the lazy dog while the cat sleeps in the warm afternoon sun near {} river"
    rows = [(i, base.format(f"r{i:03d}") + f"\nline of its own, number {i * 7919}", "a") for i in range(300)]
    made = {r.id: r.removed for r in line_dedup.removed_lines(make_docs(rows)).collect()}
    assert made[0] == [] and all(0 in made[i] for i in range(1, 300))


def test_a_bucket_is_compared_with_its_first_line(spark):
    rows = [(band, band * 100 + i, band * 100) for band in range(3) for i in range(50)]
    shared = spark.createDataFrame(rows, "band long, node long, first long")
    pairs = sorted((r.a, r.b) for r in line_dedup._to_first(shared).collect())
    assert pairs == sorted((band * 100, band * 100 + i) for band in range(3) for i in range(1, 50))


def test_exact_comparison_of_pairs(spark):
    words = [f"word{i}" for i in range(30)]
    lines = [" ".join(words), " ".join(words[:29]), " ".join(words[:20]), "other words", "其他的文字在这里写着很多字", "其他的文字在这里写着很多"]
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    pairs = spark.createDataFrame([(a, b) for a in range(6) for b in range(a + 1, 6)], "a long, b long")
    got = {(r.a, r.b) for r in line_dedup._similar(pairs, texts).collect()}
    assert got == set(plain.similar(_sets(lines), 80)) == {(0, 1), (4, 5)}


def test_edges(make_docs):
    rows = [
        (2, "Same Line here, twice\n\n same  line HERE, twice \nab", "a"), (1, "same line here, twice", "a"),
        (3, None, None), (4, "", "a"), (5, " \n\t", "a"), (6, "AB\nabc", "a"), (None, "abc", None),
        (7, "\n".join(f"line {i % 50} of a very long text " + "x" * 40 for i in range(5000)), "a"), (8, "ab", "a"), (8, "ab", "a"),
    ]
    docs = make_docs(rows, clashing=True)
    made = {r.id: (r.n_lines, r.removed) for r in line_dedup.removed_lines(docs).collect()}
    assert made[1] == (1, []) and made[2] == (3, [0, 2]) and made[None] == (1, [])
    assert made[6] == (2, [0, 1]) and made[8] == (1, [0]) and 5 not in made
    kept = line_dedup.dedup(docs)
    assert kept.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert set(got) == {1, 2, 3, 4, 5, 7, None}
    assert got[2] == ("\nab", 3) and got[3] == (None, None) and got[4][0] == "" and got[1][0] == rows[1][1]


def test_no_documents(make_docs):
    assert line_dedup.dedup(make_docs([])).collect() == []
    assert line_dedup.removed_lines(make_docs([(1, None, None)])).collect() == []


def test_bands_follow_the_similarity(spark):
    """Lines at the threshold meet in a band nearly always, strangers hardly ever."""
    chance = random.Random(3)
    rows = []
    for i in range(400):
        words = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(60)]
        other = list(words)
        # One exchanged word of 60: about 0.9 of the shingles are shared.
        other[chance.randrange(60)] = "#"
        rows += [(i, 0, " ".join(words)), (i, 1, " ".join(other))]
    frame = spark.createDataFrame(rows, "pair long, side long, line string")
    sketch = F.slice(line_dedup.sampled(F.col("line")), 1, line_dedup.SKETCH)
    keyed = frame.select("pair", "side", sketch.alias("sketch"))
    keyed = keyed.select("pair", "side", line_dedup.bands(F.col("sketch")).alias("bands")).collect()
    found = defaultdict(dict)
    for r in keyed:
        found[r.pair][r.side] = set(r.bands)
    assert sum(bool(f[0] & f[1]) for f in found.values()) >= 396
    assert sum(bool(found[i][0] & found[i + 1][1]) for i in range(399)) == 0


@pytest.mark.parametrize("text", ["a", "exactly8", "nine char", "a b c d", "oneverylongwordofletters105", "汉字 x🙂é", "the same the same", "a\u2028 b c"])
def test_the_sample_of_a_line(spark, text):
    frame = spark.createDataFrame([(text,)], "line string").select(line_dedup.sampled(F.col("line")).alias("s"))
    begins = [i for i in range(len(text)) if i == 0 or text[i - 1] in " 05" or text[i - 1] >= "\u2e80"]
    assert len(frame.first().s) == len({text[i : i + 8] for i in begins})


def test_the_main_path_has_no_python(make_docs):
    plan = line_dedup.dedup(make_docs([(1, "a", "b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_partners_meet_in_a_bucket_of_strangers(spark, monkeypatch):
    """Lines of one template in one bucket, whose first line resembles only one of them."""
    monkeypatch.setattr(line_dedup, "CHUNK", 40)
    chance = random.Random(5)
    word = lambda: "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    shared = " ".join(word() for _ in range(30))
    lines = [f"{shared} {' '.join(word() for _ in range(12))}" for _ in range(100)]
    lines += [f"{line} end" for line in lines]
    rows = [(1, i, 0) for i in range(200)]
    buckets = spark.createDataFrame(rows, "band long, node long, first long")
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    made = {r.node: r.root for r in line_dedup._links(buckets, texts).collect()}
    assert made == {i + 100: i for i in range(100)}


def test_sets_hold_a_shingle_at_every_character(spark):
    lines = ["a", "exactly8", "nine char", "a b c d e f g h", "汉字 x🙂é und noch ein paar", "x" * 50]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    made = [len(r.s) for r in frame.select(line_dedup.character_set(F.col("line")).alias("s")).collect()]
    assert made == [len({x[i : i + 8] for i in range(max(1, len(x) - 7))}) for x in lines]


def test_one_changed_character_of_a_hundred_is_similar(spark):
    # 85 of 101 shingles are shared; of runs of three words only 14 of 20.
    line = " ".join(f"word{chr(97 + i)}" for i in range(20))[:100]
    texts = spark.createDataFrame([(0, line), (1, line[:50] + "#" + line[51:])], "node long, line string")
    pairs = spark.createDataFrame([(0, 1)], "a long, b long")
    assert line_dedup._similar(pairs, texts).count() == 1


def test_signatures_take_the_shingles_of_every_character(make_docs):
    """Lines without a blank, a 0, a 5 or a wide character that differ in the first letter."""
    chance = random.Random(11)
    rows = []
    for i in range(40):
        line = "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=120))
        rows += [(2 * i, line, "a"), (2 * i + 1, "#" + line[1:], "a")]
    made = {r.id: r.removed for r in line_dedup.removed_lines(make_docs(rows)).collect()}
    assert made == {i: [0] if i % 2 else [] for i in range(80)}


def test_signatures_follow_the_set_alone(spark):
    lines = ["x" * 8, "x" * 9, "x" * 100, "", "short", "é" * 30, "é" * 25, "ab" * 10, "ab" * 60, "ab" * 60]
    frame = spark.createDataFrame([(i if i < 9 else 8, x) for i, x in enumerate(lines)], "node long, line string")
    made = {r.node: (r.n, r.bands) for r in line_dedup.signatures(frame).collect()}
    assert all(len(set(bands)) == len(line_dedup.SQUARE) == 16 for _, bands in made.values())
    same = [[0, 1, 2], [3], [4], [5, 6], [7, 8]]
    assert [{tuple(made[i][1]) for i in group} for group in same] == [{tuple(made[g[0]][1])} for g in same]
    assert len({tuple(bands) for _, bands in made.values()}) == len(same)
    assert {i: n for i, (n, _) in made.items()} == {i: 1 + (i == 8) for i in range(9)}


def test_lines_are_normalised_alike_with_and_without_wide_characters(spark):
    lines = ["  A\tB  c ", "É\tB  C", "x", "\x0bZ\x0c\r", "İSTANBUL  ABC", "PLAIN", "a\x1fB", "tab\t\tTAB"]
    frame = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    made = frame.select("i", line_dedup.normalised(F.col("line")).alias("x")).collect()
    assert {r.i: r.x for r in made} == dict(enumerate(map(_normal, lines)))


def test_variants_of_a_frequent_line_are_not_all_compared(make_docs, monkeypatch):
    """Each variant resembles the line that most documents have, but hardly another variant."""
    chance = random.Random(2)
    words = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(50)]
    rows = [(i, " ".join(words), "a") for i in range(5)]
    for i in range(400):
        other = list(words)
        for at in chance.sample(range(50), 2):
            other[at] = "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=5))
        rows.append((5 + i, " ".join(other), "a"))
    compared, similar = [], line_dedup._similar

    def counted(pairs, texts):
        compared.append(pairs.count())
        return similar(pairs, texts)

    monkeypatch.setattr(line_dedup, "_similar", counted)
    made = {r.id: r.removed for r in line_dedup.removed_lines(make_docs(rows)).collect()}
    # A few variants may share no band with it.
    assert sum(not gone for gone in made.values()) <= 4
    assert sum(compared) <= 3 * 400


def test_two_bands_have_one_place_in_common_at_most():
    square = [set(places) for places in line_dedup.SQUARE]
    assert all(len(places) == 4 for places in square)
    assert max(len(a & b) for i, a in enumerate(square) for b in square[:i]) == 1


def test_bands_are_dealt_once(spark):
    rows = [(i, 1, [i // 2, 100 + i, 200]) for i in range(6)] + [(6, 3, [3, 106, 300])]
    signed = spark.createDataFrame(rows, "node long, n long, bands array<long>").repartition(2, "node")
    got = {(r.band, r.node, r.n) for r in line_dedup._buckets(signed).collect()}
    assert got == {(i // 2, i, 1) for i in range(6)} | {(200, i, 1) for i in range(6)}
    # Without adaptive execution the plan shows which shuffles are read again.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = line_dedup._buckets(signed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(band" in x]
    assert sorted("ReusedExchange" in x for x in dealt) == [False, True]


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        place = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in place.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before, key = files(), spark.conf.get(session.CLEANUP, None)
    rows = session.stored(spark.range(1000).repartition(3, "id").groupBy("id").count(), "counted")
    for _ in range(100):
        left = {f for f in files() - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(session.CLEANUP, None) == key
    assert rows.count() == 1000


def test_lower_changes_no_other_wide_character(spark):
    """All characters that ``lower`` changes are those that the quick way leaves out."""
    codes = spark.range(0x80, 0x110000).filter("id < 55296 or id > 57343")
    made = codes.select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    assert made.filter((F.lower("c") != F.col("c")) & ~F.col("c").rlike(line_dedup.CASED)).count() == 0


def test_lower_of_wide_lines_keeps_wide_letters(spark):
    lines = ["ÉCOLE Été", "naïve CAFÉ", "漢字 ABC", "ΣΑΣ OK", "“Quoted” Text", "Ⅷ Ⓐ X", "é\tÀ  B", "ǅ A"]
    frame = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    made = {r.i: r.x for r in frame.select("i", line_dedup.normalised(F.col("line")).alias("x")).collect()}
    assert made == dict(enumerate(map(_normal, lines)))


def test_marks_are_those_of_the_distinct_shingles(spark):
    lines = ["short", "exactly8", "ab" * 40, "the same the same the same words", "x" * 300, "漢字 x🙂é und noch ein paar Wörter"]
    lines += ["".join(chr(97 + i * i % 26) for i in range(k)) for k in (22, 23, 24, 25, 200)]
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    sets = texts.select("node", line_dedup.character_set(F.col("line")).alias("s")).collect()
    want = {}
    for r in sets:
        bits = [0] * line_dedup.WORDS
        for x in r.s:
            bits[x % line_dedup.WORDS] ^= 1 << (x >> 8 & 63)
        want[r.node] = (len(r.s), [b - 2**64 if b >= 2**63 else b for b in bits])
    made = line_dedup._marks(texts).collect()
    assert {r._node: (r.size, [r[f"bits_{k}"] for k in range(line_dedup.WORDS)]) for r in made} == want
