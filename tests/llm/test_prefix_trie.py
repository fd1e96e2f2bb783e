"""The prefix trie: range minima and one part against plain scans, whole results against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every prefix of every rebuilt conversation, by dictionaries."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    kids = defaultdict(list)
    for path in nodes:
        if path:
            kids[path[:-1]].append(path)

    def told(path):
        leaves, saved = (0 if kids[path] else 1), (len(nodes[path]) - 1) * (len(path[-1][1]) if path else 0)
        for kid in kids[path]:
            more = told(kid)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for path, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(seqs[c]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(kids[path]), *told(path), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*T.COLUMNS).collect()), key=repr)


@settings(deadline=None)
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=70), least=st.integers(0, 6))
def test_reach_is_the_plain_scan(values, least):
    table, n = T.RangeMinimum(np.array(values)), len(values)
    at = np.arange(n)
    right = [next((j for j in range(i, n) if values[j] < least), n) for i in range(n)]
    left = [next((j for j in range(i, -1, -1) if values[j] < least), -1) for i in range(n)]
    assert table.reach_right(at, np.full(n, least)).tolist() == right
    assert table.reach_left(at, np.full(n, least)).tolist() == left
    first, last = np.triu_indices(n)
    assert table.least(first, last).tolist() == [min(values[a : b + 1]) for a, b in zip(first, last, strict=True)]


@settings(deadline=None)
@given(a=st.lists(st.integers(0, 2), max_size=9), b=st.lists(st.integers(0, 2), max_size=9))
def test_shared_turns(a, b):
    n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    key = [b"".join(bytes([x]) * T.DIGEST for x in s) for s in (a, b)]
    assert T.shared_turns(*key) == n
    assert T.shared_turns(None, key[0]) == T.NOWHERE


@settings(deadline=None)
@given(
    sequences=st.sets(st.lists(st.integers(0, 2), max_size=5).map(tuple), min_size=1, max_size=25),
    cut=st.integers(1, 25),
    together=st.integers(1, 9),
)
def test_parts_add_up_to_the_whole(sequences, cut, together):
    """However the sorted sequences are cut, sums of the parts are those of one part."""
    keys = sorted(b"".join(bytes([x]) * T.DIGEST for x in s) for s in sequences)

    def walk(lo, hi):
        mine = keys[lo:hi]
        rows = pa.table(
            {
                "key": pa.array(mine[::-1], pa.binary()),
                "sizes": pa.array([[1 + x for x in k[:: T.DIGEST]] for k in mine[::-1]], pa.list_(pa.int64())),
                "n": pa.array([1 + len(k) % 3 for k in mine[::-1]], pa.int64()),
                "first_conv": pa.array([keys.index(k) * 7 % 11 for k in mine[::-1]], pa.int64()),
                "ends_sha256": pa.array(["x" for _ in mine], pa.string()),
            }
        )
        return T.Part(rows, keys[lo - 1] if lo else None, keys[hi] if hi < len(keys) else None).nodes().to_pylist()

    whole = walk(0, len(keys))
    assert all(r["node"] is None and r["parent"] is None for r in whole)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(T, "SEARCHED_TOGETHER", together)
        parts = [r for lo in range(0, len(keys), cut) for r in walk(lo, min(lo + cut, len(keys)))]
    met = {}
    for r in parts:
        name = r["node"] or (r["conv_id"], r["depth"], r["n_convs"], r["saved_tokens"], id(r))
        if name in met:
            old = met[name]
            r = {**r, **{c: r[c] + old[c] for c in T.SUMS}, "conv_id": min(r["conv_id"], old["conv_id"]), "ends_sha256": r["ends_sha256"] or old["ends_sha256"]}
        met[name] = r
    above = {n: r["conv_id"] for n, r in met.items()}
    out = [{**r, "parent_conv_id": above[r["parent"]] if r["parent"] else r["parent_conv_id"]} for r in met.values()]
    told = [sorted([tuple(r[c] for c in T.COLUMNS) for r in x], key=repr) for x in (whole, out)]
    assert told[0] == told[1]


def some_conversations(seed, n, turns=4, texts=2):
    pick = random.Random(seed)
    return [
        (c, t, pick.choice(["user", "bot", None]), pick.choice(["", "a", "ü🙂", None, "long text"][:texts]))
        for c in pick.sample(range(0, 450), n)
        for t in range(pick.randrange(1, turns + 1))
    ]


AWKWARD = [
    (1, None, "user", "null turn first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, None, "no role"), (1, 3, None, None), (1, 3, None, None),
    (None, 0, "user", "of none"), (205, 1, "x", "y"), (7, 5, "", ""), (7, 5, "", "z" * 70 + "b"), (7, 5, "", "z" * 70 + "a"), (2**40, 0, "u", "far"),
]


@pytest.mark.parametrize("seed, turns, texts", [(1, 4, 2), (2, 12, 3), (3, 2, 1)])
def test_whole_results(spark, seed, turns, texts):
    rows = some_conversations(seed, 120, turns, texts)
    assert rows_of(T.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_hot_conversation_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "IDS_TOGETHER", 16)
    monkeypatch.setattr(T, "TURNS_PER_PART", 5)
    monkeypatch.setattr(T, "BROADCAST_ROWS", 0)
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)] + some_conversations(5, 60, 6, 4)
    assert rows_of(T.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_awkward_rows_and_extra_columns(spark):
    rows = [r for r in AWKWARD if r[0] != 7] + [(7, 5, "", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as sizes", "3 as part", "4 as depth")
    assert rows_of(T.trie(df)) == plain(rows)
    # texts that differ beyond what orders them have some order, the same for all
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    assert rows_of(T.trie(df)) == rows_of(T.trie(df.orderBy("text")))


def test_empty_table(spark):
    assert T.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert T.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
