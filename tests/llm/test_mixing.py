"""Poisson replication: counts against the distribution, rates against targets."""

import hashlib
import math
from collections import Counter

from plumbline.llm import mixing as M


def inverse(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total <= u:
        k += 1
        p *= mean / k
        total += p
    return k


def unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def test_counts_invert_the_distribution(docs):
    rows = [(i, "x" * (50 if i % 3 else 10), "en", "big" if i % 3 else "small", 0) for i in range(600)]
    frame = docs(*rows)
    got = Counter(r["doc_id"] for r in M.mix(frame, {"big": 0.5, "small": 0.5}, budget=2.0).collect())
    sizes = {"big": 400 * 50, "small": 200 * 10}
    mean = {s: 0.5 * 2 * sum(sizes.values()) / n for s, n in sizes.items()}
    for i, _, _, source, _ in rows:
        assert got[i] == inverse(mean[source], unit(f"{M.SEED}:{i}"))
    small = sum(got[i] for i, *_ in rows if i % 3 == 0) * 10
    assert abs(small / (small + sum(got[i] for i, *_ in rows if i % 3) * 50) - 0.5) < 0.05


def test_shuffled_over_all_partitions(docs):
    keys = [r["shuffle_key"] for r in M.mix(docs(*[(i, "text", "en", f"s{i % 4}", 4) for i in range(300)])).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_nulls_empty_texts_unnamed_sources_and_empty_table(docs):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "abc", "en", "a", 3), (2, "abc", "en", "a", 3)]
    got = M.mix(docs(*rows), budget=5.0).collect()
    counts = Counter((r["doc_id"], r["source"]) for r in got)
    assert counts[(2, "a")] % 2 == 0  # equal rows draw equal counts
    assert M.mix(docs(*rows), {"a": 1.0}).where("source is null").count() == 0
    assert M.mix(docs(*rows), {}).count() == 0
    assert M.mix(docs()).count() == 0


def test_large_means_do_not_underflow(docs, spark):
    from pyspark.sql import functions as F

    steps = spark.range(1).select(M._cumulative(F.lit(2000.0)).alias("c")).first()["c"]
    assert abs(steps[-1] - 1) < 1e-9 and abs(sum(1 - c for c in steps) - 2000) < 1e-3
