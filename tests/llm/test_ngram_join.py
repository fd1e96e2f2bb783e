"""The n-gram join and connected components against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from plumbline.llm import ngram_join as N
from plumbline.llm.components import connected

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def brute_force(rows):
    sets = [plain_set(t) for _, t in rows]
    found = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])])
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if found[j] == found[k] and rows[j][0] is not None]
        out.append((doc_id, len(sets[k]), doc_id if not sets[k] else min(ids, default=None)))
    return sorted(out, key=str)


def corpus(seed, size=260):
    """Originals, edited copies, chains of edits, shared passages, texts of few words."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghij") + str(r.randrange(40))
    passage = [word() for _ in range(30)]
    texts = []
    while len(texts) < size:
        kind = r.random()
        if kind < 0.35 and texts:
            words = r.choice(texts).split()
            for _ in range(r.randrange(1, 4)):
                if words:
                    words[r.randrange(len(words))] = word()
            texts.append(" ".join(words))
        elif kind < 0.45:
            texts.append(" ".join(r.choice("xy") for _ in range(r.randrange(0, 9))))
        elif kind < 0.6:
            at = [word() for _ in range(r.randrange(5, 60))]
            texts.append(" ".join(at[:3] + passage + at[3:]))
        else:
            texts.append(" ".join(word() for _ in range(r.choice([3, 6, 8, 20, 60, 200]))))
    return texts


@pytest.mark.parametrize("seed,bound", [(1, None), (2, 3), (3, 40)])
def test_against_brute_force(docs, monkeypatch, seed, bound):
    if bound:  # all large, or most small
        monkeypatch.setattr(N, "boundary", lambda levels: bound)
    rows = list(enumerate(corpus(seed)))
    got = [tuple(r) for r in N.joined(docs(*rows)).collect()]
    assert sorted(got, key=str) == brute_force(rows)


def test_hub_lists_and_hot_lists(docs, monkeypatch):
    """A large group of near copies around one text, in lists dealt to several tasks."""
    monkeypatch.setattr(N, "HOT_LIST", 10)
    r = random.Random(7)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        for _ in range(r.randrange(1, 8)):
            words[r.randrange(len(words))] = f"v{i}{r.random()}"
        rows.append((i, " ".join(words)))
    assert sorted(map(tuple, N.joined(docs(*rows)).collect()), key=str) == brute_force(rows)


def test_edge_cases(docs):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one TWO"), (10, "ONE two three"), (None, "one two"), (None, None),
        (11, "É é a b c d"), (12, "é é a b c d"), (13, long), (14, long + " x"), (4, long), (4, long), (15, "a b c d e"), (16, "a b c d e a b c d e"),
        (17, "p q r s t u"), (18, "p q r s t u"),
    ]
    got = sorted(map(tuple, N.joined(docs(*rows).withColumnRenamed("lang", "fp").withColumnRenamed("source", "root")).collect()), key=str)
    assert got == brute_force(rows)
    assert N.joined(docs()).count() == 0


@given(a=st.sets(st.integers(0, 400)), b=st.sets(st.integers(0, 400)))
def test_links_and_bound(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert N.linked(x, y) == linked(a, b)
    if linked(a, b):
        assert len(a & b) >= N.least_overlap(len(a), len(b))


def test_sketches_err_on_no_link():
    r = np.random.default_rng(0)
    for _ in range(200):
        n = int(r.integers(2, 3000))
        both = r.integers(0, 2**63, n).astype(np.uint64)
        cut = max(1, int(n * 0.125))
        a, b = np.unique(both[cut:]), np.unique(both[: n - cut])
        if N.linked(a, b):
            x, y = ((s[: N.SKETCH] >> np.uint64(32)).astype("<u4") for s in (a, b))
            assert N.alike(x, y) >= N.SCREEN


def test_shingles_ignore_case_of_ascii_only():
    s = N.Shingler()
    assert (s("A b C d E f") == s("a B c D e F")).all() and len(s("a b c d e f")) == 2
    assert len(s("a b")) == 1 and not np.array_equal(s("a b"), s("a  c"))
    assert not np.array_equal(s("Ä b"), s("ä b")) and np.array_equal(s("x\vy"), s("x y"))


@pytest.mark.parametrize("edges", [[], [(1, 1), (2, None)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(60, 61), (61, 62)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e if None not in e and e[0] != e[1]}
    found = roots(100, [e for e in edges if None not in e])
    assert got == {x: found[x] for x in nodes}


def test_the_driver_counts_levels_without_a_wider_copy_of_the_table():
    levels = np.random.default_rng(1).integers(0, 256, 8 * N.PIECE + 5, dtype=np.uint8)
    assert (N._slots_by_level(levels) == np.bincount(levels, minlength=256)).all()
    assert (N._slots_by_level(levels[:0]) == 0).all()
    tracemalloc.start()
    try:
        N.boundary(levels)
        assert tracemalloc.get_traced_memory()[1] < 2 * len(levels)
    finally:
        tracemalloc.stop()
