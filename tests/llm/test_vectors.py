"""Vector join and neighbour search against brute force."""

import numpy as np
import pytest

from plumbline.llm import near_vectors as V
from plumbline.llm import neighbours as K

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, label int, embedding array<float>"


def rows(seed=0, n=300, d=24):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n, d))
    for i in range(n // 2, n):  # near copies, scaled, some at the edge
        base[i] = (base[r.integers(n // 2)] + r.standard_normal(d) * r.choice([0.02, 0.25, 0.35])) * r.choice([1, 7.5])
    base[10] = base[11] = base[12]
    base[13] = -base[12]
    out = [(i, int(i % 3), [float(x) for x in np.float32(v)]) for i, v in enumerate(base)]
    odd = [
        (900, 1, None), (901, 1, []), (902, 1, [0.0] * d), (903, 1, [NAN] + [1.0] * (d - 1)), (904, 1, [INF] * d), (905, 1, [None] + [1.0] * (d - 1)),
        (906, None, out[0][2]), (907, 0, [1.0, 0.0, 2.0]), (908, 0, [2.0, 0.0, 4.0]), (909, 0, [2.0, -0.0, 4.0]), (5, 2, out[5][2]),
    ]
    return out + odd


def usable(v):
    return v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_force(table):
    n = len(table)
    links, up = [0] * n, list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            (_, k, a), (_, m, b) = table[i], table[j]
            if k is None or k != m or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a, "f8"), np.array(b, "f8")
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    ids = [r[0] for r in table]
    first = [min(ids[j] for j in range(n) if find(j) == find(i)) for i in range(n)]
    return sorted((ids[i], links[i], first[i], ids[i] == first[i]) for i in range(n))


@pytest.mark.parametrize("cell_rows", [V.CELL_ROWS, 20])
def test_near_duplicates(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(V, "CELL_ROWS", cell_rows)
    table = rows()
    got = V.near_duplicates(spark.createDataFrame(table, SCHEMA))
    assert sorted(map(tuple, got.collect())) == brute_force(table)


def test_near_duplicates_without_ids_or_rows(spark):
    table = [(None, 1, [1.0, 2.0]), (None, 1, [1.0, 2.0]), (3, 1, [2.0, 4.0]), (None, 2, [1.0, 0.0])]
    got = V.near_duplicates(spark.createDataFrame(table, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == [
        ("3", 2, "3"), ("None", 0, "None"), ("None", 2, "3"), ("None", 2, "3"),
    ]
    assert V.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def nearest(table, query, k):
    good = {(r[0], tuple(r[2])) for r in table if r[0] is not None and usable(r[2])}
    q = next(v for i, v in good if i == query)
    found = sorted((float(np.sqrt(((np.array(v, "f8") - np.array(q, "f8")) ** 2).sum())), i) for i, v in good if i != query and len(v) == len(q))
    return [(query, n + 1, i, s) for n, (s, i) in enumerate(found[:k])]


def test_neighbours_when_all_leaves_are_visited(spark):
    table = [r for r in rows(1) if r[0] != 907]
    got = K.nearest(spark.createDataFrame(table, SCHEMA), "vec_id % 50 = 0", 7, visited=99)
    asked = [r[0] for r in table if r[0] % 50 == 0 and usable(r[2])]
    expected = [x for q in sorted(set(asked)) for x in nearest(table, q, 7)]
    found = sorted(map(tuple, got.collect()))
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f[3] for f in found], [e[3] for e in expected], rtol=1e-14)


@pytest.mark.parametrize("same", [True, False])
def test_repeated_ids_take_no_places_of_others(spark, same):
    r = np.random.default_rng(5)
    base = r.standard_normal((40, 8))
    # each row 12 times, or 12 vectors of each id that lie close together; all in one leaf
    table = [(i, 0, [float(x) for x in np.float32(v + (0 if same or i == 0 else 1e-3 * n))]) for i, v in enumerate(base) for n in range(12)]
    got = sorted(map(tuple, K.nearest(spark.createDataFrame(table, SCHEMA), "vec_id = 0", 10, sample=5, visited=99).collect()))
    q = np.float32(base[0]).astype("f8")
    least = {}
    for i, _, v in table[12:]:
        least[i] = min(least.get(i, INF), float(np.sqrt(((np.array(v) - q) ** 2).sum())))
    expected = sorted((s, i) for i, s in least.items())[:10]
    assert [(g[1], g[2]) for g in got] == [(n + 1, i) for n, (_, i) in enumerate(expected)]
    assert np.allclose([g[3] for g in got], [s for s, _ in expected], rtol=1e-12)


def test_recall_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "LEAF_ROWS", 60)
    monkeypatch.setattr(K, "LEAF_QUERIES", 3)
    table = [(i, 0, [float(x) for x in v]) for i, v in enumerate(np.float32(np.random.default_rng(3).standard_normal((3000, 32))))]
    got = K.nearest(spark.createDataFrame(table, SCHEMA), "vec_id % 100 = 0", 10).collect()
    assert len(got) == 300
    true = {(q, x[2]) for q in range(0, 3000, 100) for x in nearest(table, q, 10)}
    assert len({(r["query_id"], r["vec_id"]) for r in got} & true) >= 0.9 * len(true)


def test_neighbours_of_few_or_no_rows(spark):
    table = [(100, 0, [1.0, 1.0]), (1, 0, [1.0, 1.0]), (2, 0, [1.0, 1.0]), (3, 0, None)]
    got = sorted(map(tuple, K.nearest(spark.createDataFrame(table, SCHEMA), "vec_id % 100 = 0", 10).collect()))
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 0.0)]
    assert K.nearest(spark.createDataFrame([], SCHEMA), "vec_id % 100 = 0", 10).count() == 0


def test_ties_at_the_tenth_place_go_to_smaller_ids(spark):
    """Five nearer rows, then thirty at one distance: the five of them with the smallest ids follow."""
    query = [1.0] + [0.0] * 15
    near = [(i, [1.0 + i / 100] + [0.0] * 15) for i in range(101, 106)]
    tied = [(i, [1.0] + [4.0 if k == i % 15 else 0.0 for k in range(15)]) for i in range(230, 200, -1)]
    rows = [(100, query), *near, *tied]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = K.nearest(df, "vec_id = 100", 10, visited=99.0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [101, 102, 103, 104, 105, 201, 202, 203, 204, 205]
    assert [r["score"] for r in got[5:]] == [4.0] * 5
