from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestide.llm import mixing, queries
from tests.llm import plain


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by filling up step by step."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {name: weights[i % 3] for i, name in enumerate(names)}
    total, made, left = share * sum(sizes.values()), {}, set(names)
    while left:
        level = (total - sum(made.values())) / sum(weight[n] for n in left)
        over = {n for n in left if weight[n] * level > most * sizes[n]}
        if not over:
            made |= {n: weight[n] * level for n in left}
            break
        made |= {n: most * sizes[n] for n in over}
        left -= over
    return made


def _sizes(rows):
    found = {}
    for _, text, source in rows:
        found[source] = found.get(source, 0) + len(plain.words(text))
    return found


def _check(rows, made):
    want, sizes = targets(_sizes(rows)), _sizes(rows)
    taken, largest = {}, {}
    for r in made:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for source, words in taken.items():
        assert abs(words - want[source]) <= largest[source] / 2 + 1e-6


def test_the_small_table(spark, small):
    docs, rows = small
    made = mixing.mix(docs).collect()
    _check([tuple(r) for r in rows], made)
    query = {r.doc_id: r.taken for r in queries.mixture(spark, plain.FOLDER).collect()}
    assert query == {r.id: r.taken for r in made}


def test_reruns_agree_whatever_the_partitions(small):
    docs, _ = small
    runs = [docs, docs.repartition(7), docs.orderBy(F.desc("doc_id")).coalesce(1)]
    assert len({tuple(sorted((r.id, r.taken) for r in mixing.mix(d).collect())) for d in runs}) == 1


def test_blocks_combine_in_a_tree(small, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    _check([tuple(r) for r in small[1]], mixing.mix(small[0]).collect())


def test_pivots_keep_words_and_chances():
    chance = np.random.default_rng(5)
    size = chance.integers(1, 400, 40).astype(float)
    part = chance.random(40)
    seen = np.zeros(40)
    for _ in range(3000):
        made, is_open = mixing.pivot(size, part, chance.random(40))
        assert (made * size).sum() == pytest.approx((part * size).sum())
        whole = np.delete(made, is_open) if is_open >= 0 else made
        assert set(np.round(whole, 9)) <= {0.0, 1.0}
        seen += made
    assert np.abs(seen / 3000 - part).max() < 0.05


def test_edges(make_docs):
    rows = [(1, None, None), (2, "a b c", None), (3, "a b", "x"), (3, "a b", "x"), (None, "q", "x"), (4, "", "y")]
    docs = make_docs(rows, clashing=True)
    made = mixing.mix(docs).collect()
    assert len(made) == 6
    assert {r.source for r in made} == {None, "x", "y"}
    assert all(r.taken == 0 for r in made if r.size == 0)
    taken = mixing.take(docs)
    assert taken.columns[:-1] == docs.columns and taken.columns[-1] == "copies_"
    assert all(r["copies_"] > 0 for r in taken.collect())
    # Repeated rows share one outcome.
    assert len({r.taken for r in made if r.id == 3}) == 1


def test_no_documents_and_no_words(make_docs):
    assert mixing.mix(make_docs([])).collect() == []
    made = mixing.mix(make_docs([(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.taken, r.target) for r in made] == [(0, 0.0)] * 2
