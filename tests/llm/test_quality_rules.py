from __future__ import annotations

import pytest

from salestide.llm import queries, quality_rules
from salestide.llm.quality_rules import Limits
from tests.llm import plain

GOOD = " ".join(f"word{i}" for i in range(80))


def test_features_of_the_small_table(spark, small):
    made = {r.doc_id: r for r in queries.quality(spark, plain.FOLDER).collect()}
    assert len(made) == len(small[1])
    for row in small[1]:
        got, want = made[row.doc_id], plain.quality(row.text)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want
        assert got.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got.kept and got.base_failed)


@pytest.mark.parametrize("text", [
    None, "", "  \n\n", "a", "a b c", "a b c a b c", "x x x x x", "a b c d a b c", "one\n one\none\n\none ",
    "é#*$ %&|<>\x0b\x0c\r\nü", "a b c d", "🙂 🙂 🙂 🙂",
])
def test_features_of_edges(text):
    n_words, chars, symbols, n_lines, dups, repeats = quality_rules.features(text)
    assert (n_words, chars, symbols, dups, repeats) == plain.quality(text)


def _kept(docs, **options):
    rows, verdict = quality_rules.judge(docs, **options)
    return sorted((r.doc_id, r[verdict].kept, r[verdict].host_rate) for r in rows.collect())


def test_a_bad_host_takes_its_good_documents_along(make_docs):
    rows = [(i, GOOD, f"good{i % 10}") for i in range(400)]
    rows += [(1000 + i, "too short" if i else GOOD, "bad") for i in range(60)]
    rows += [(2000, "short", "small"), (2001, GOOD, "small")]
    made = {i: (kept, rate) for i, kept, rate in _kept(make_docs(rows))}
    assert all(made[i][0] for i in range(400))
    assert not made[1000][0] and made[1000][1] > 0.6
    # One bad document of two is shrunk towards the others.
    assert made[2001][0] and made[2001][1] < 0.5


def test_hosts_are_shrunk_to_the_mean_when_they_differ_by_chance_only(make_docs):
    rows = [(i, GOOD if i % 4 else "short", f"h{i // 4}") for i in range(80)]
    assert {round(rate, 3) for _, _, rate in _kept(make_docs(rows))} == {0.25}


def test_edges(make_docs):
    rows = [(1, None, None), (1, None, None), (None, GOOD, None), (3, "", "a"), (4, " ".join(f"w{i}" for i in range(150_000)), "a")]
    docs = make_docs(rows, clashing=True)
    made, verdict = quality_rules.judge(docs)
    assert verdict not in docs.columns and made.columns == [*docs.columns, verdict]
    assert made.count() == 5
    kept = quality_rules.keep_good(docs, limits=Limits(host_rate=1.0))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 4}


def test_no_documents(make_docs):
    assert quality_rules.keep_good(make_docs([])).collect() == []
