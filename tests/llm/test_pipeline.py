from __future__ import annotations

import pytest

import corpus_pipeline
from salestide.llm import quality_rules
from tests.llm import plain
from tests.llm.test_line_dedup import _normal
from tests.llm.test_mixing import _check


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """What each stage gets and gives on the small table."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, found = spark.read.parquet(f"{plain.FOLDER}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, plain.FOLDER)
        made.write.parquet(f"{folder}/{number}")
        made = spark.read.parquet(f"{folder}/{number}")
        found.append((docs, made, docs.collect(), made.collect()))
        docs = made
    return found


def test_all_stages_but_the_last_return_the_columns_of_documents(results):
    for before, after, _, _ in results[:-1]:
        assert after.columns == before.columns


def test_quality_rules_keep_clean_documents(results):
    _, _, before, after = results[0]
    kept = {r.doc_id for r in after}
    for r in before:
        n_words, _, _, _, repeats = plain.quality(r.text)
        assert (r.doc_id in kept) == (n_words >= 50 and 100 * repeats <= 50 * n_words)


def test_lines_that_stay_are_all_different(results):
    _, _, before, after = results[1]
    lines = [_normal(line) for r in after for line in r.text.split("\n") if _normal(line)]
    assert len(lines) == len(set(lines))
    assert {_normal(x) for r in before for x in r.text.split("\n")} >= set(lines)
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_document_of_each_group_stays(results):
    _, _, before, after = results[2]
    before = sorted(before, key=lambda r: r.doc_id)
    sets = [plain.shingles(r.text, 5) for r in before]
    top = plain.classes(len(sets), plain.similar(sets, 80))
    want = {before[i].doc_id for i, t in enumerate(top) if i == t}
    assert {r.doc_id for r in after} == want


def test_no_benchmark_item_is_left(results):
    _, _, before, after = results[3]
    assert len(after) < len(before) or len(before) < 100
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}


def test_the_mix_takes_what_the_targets_say(results):
    docs, _, before, after = results[4]
    from salestide.llm import mixing

    _check([(r.doc_id, r.text, r.source) for r in before], mixing.mix(docs).collect())
    copies = {r.id: r.copies for r in mixing.mix(docs).collect()}
    assert {r.doc_id: r.copies for r in after} == {i: n for i, n in copies.items() if n}


def test_the_whole_run(spark, results):
    whole = corpus_pipeline.run(spark, plain.FOLDER).collect()
    assert sorted((r.doc_id, r.copies) for r in whole) == sorted((r.doc_id, r.copies) for r in results[-1][3])


def test_edges(spark, make_docs):
    rows = [(None, None, None), (1, "", "a"), (1, "", "a"), (2, "w " * 90, "b"), (3, " ".join(f"w{i}" for i in range(70)), None)]
    for given in (rows, []):
        docs = make_docs(given, clashing=True)
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, plain.FOLDER)
            assert made.columns[: len(docs.columns)] == docs.columns
            docs = made
        assert {r.doc_id for r in docs.collect()} <= {3}
    assert quality_rules.keep_good(make_docs(rows)).count() == 1
