"""Ranked search: terms, the shared sums, and whole results against a plain version."""

import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from plumbline.llm import ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, best=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    found = []
    for item, terms in asked.items():
        scores = []
        for at, (i, c) in enumerate(counts):
            m, score = 10 + 90 * c.total() * n_docs // n_terms, 0
            for t in terms & set(c):
                df = sum(t in other for _, other in counts)
                score += floor(1000 * log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, at, i))
        found += [(item, rank, s[4], -s[0]) for rank, s in enumerate(sorted(scores)[:best], 1)]
    return sorted(found, key=repr)


@given(text=st.text())
def test_terms_are_the_matches(text):
    text = text.encode("utf-8", "replace").decode()
    assert [t.decode() for t in R.terms_of(text)] == plain_terms(text)


@given(items=st.lists(st.sets(st.integers(0, 30)), max_size=20))
def test_shared_sums_are_the_sums(items):
    graph = R.share(items, 31)
    weighted = np.random.default_rng(1).integers(0, 1000, (31, 7))
    expected = [weighted[sorted(i)].sum(axis=0) for i in items]
    assert np.array_equal(graph.scores(weighted), np.array(expected).reshape(len(items), 7))
    assert graph.additions <= sum(max(0, len(i) - 1) for i in items)


def test_a_shared_set_is_summed_once():
    common = set(range(40))
    graph = R.share([common | {40 + k} for k in range(20)], 60)
    assert graph.additions == 39 + 20


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [
    (1, "The cat sat. THE CAT"), (2, "cat"), (3, None), (4, ""), (5, "... !!"), (6, "straße Straße STRASSE x9"), (7, "cat"), (7, "cat"),
    (None, "cat"), (8, "dog " * 5000), *[(100 + k, f"cat dog bird{k % 3} the") for k in range(30)],
]
ITEMS = [(1, "The cat"), (2, None), (3, "straße, Straße"), (3, "dog"), (None, "bird1 the"), (4, "absent"), (5, "cat cat cat")]


@pytest.mark.parametrize("at_once", [R.TERMS_AT_ONCE, 2])
def test_whole_results(spark, docs, monkeypatch, at_once):
    monkeypatch.setattr(R, "TERMS_AT_ONCE", at_once)
    monkeypatch.setattr(R, "CELLS", 50)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as rank", "2 as doc_id")
    assert rows(R.search(docs(*DOCS), items)) == plain(DOCS, ITEMS)
    assert rows(R.search(docs(*DOCS).selectExpr("*", "1 as n", "2 as terms"), items, 3)) == plain(DOCS, ITEMS, 3)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert R.search(docs(), items).count() == 0
    assert R.search(docs((1, None)), items).count() == 0
    assert R.search(docs(*DOCS), items.limit(0)).count() == 0
