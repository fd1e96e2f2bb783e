"""Vector best fit: the choice of windows against a plain version, ids against the tokenizer, cuts and places."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import vector_packing as P

TEXTS = ["", "a", "  two  spaces ", "line\nbreak \n end", "straße né ł ∑ 漢字 🙂", "don't 12'3 <|endoftext|>", "word " * 3000, "\n", "w " * 1023, "w " * 1022, "w " * 2047, "x "]


def plain(lengths, room):
    """Windows one by one: (sequence, offset) of each piece."""
    limits = [room.tokens, room.documents, room.cost]
    open_, place = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = [lengths[i], 1, lengths[i] ** 2]
        best = None
        for w, used in enumerate(open_):
            left = [limit - u for limit, u in zip(limits, used, strict=True)]
            if any(n > x for n, x in zip(need, left, strict=True)):
                continue
            if room.rule == "norm":
                score = sum(g * ((x - n) / limit) ** 2 for g, x, n, limit in zip(room.weights, left, need, limits, strict=True))
            else:
                score = -sum(g * x * n / limit**2 for g, x, n, limit in zip(room.weights, left, need, limits, strict=True))
            if best is None or score < best[0] - 1e-12:
                best = (score, w)
        if best is None:
            open_.append([0, 0, 0])
            best = (0, len(open_) - 1)
        used = open_[best[1]]
        place[i] = (best[1], used[0])
        open_[best[1]] = [u + n for u, n in zip(used, need, strict=True)]
    return [place[i] for i in range(len(lengths))]


@settings(max_examples=150, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 40), max_size=200),
    documents=st.integers(1, 12),
    cost=st.integers(1600, 4000),
    rule=st.sampled_from(["norm", "dot"]),
)
def test_windows_are_those_of_the_plain_version(lengths, documents, cost, rule):
    room = P.Capacities(40, documents, cost, (1.0, 0.5, 0.25), rule)
    sequence, offset = P.vector_best_fit(np.array(lengths, "i8"), room)
    assert list(zip(sequence.tolist(), offset.tolist(), strict=True)) == plain(lengths, room)


@given(lengths=st.lists(st.integers(1, 1024), max_size=300))
def test_nearly_as_few_windows_as_there_can_be(lengths):
    sequence, _ = P.vector_best_fit(np.array(lengths, "i8"))
    assert sequence.max(initial=-1) + 1 <= 11 / 9 * -(-sum(lengths) // 1024) + max(1, sum(n > 512 for n in lengths))


def test_a_piece_beyond_every_window_is_told():
    with pytest.raises(ValueError):
        P.vector_best_fit(np.array([41]), P.Capacities(40))


def test_cuts():
    assert [P.cuts(n) for n in (1, 1024, 1025, 2048, 2050)] == [[0], [0], [0, 1], [0, 1024], [0, 2, 1026]]


def test_every_id_lies_in_one_place(docs):
    own = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    rows = [*enumerate(TEXTS), (99, None), (None, "no id"), (6, TEXTS[6]), *[(100 + i, "some words " * (i * 13)) for i in range(60)], *[(500, "copy " * 7)] * 40]
    texts = {i: t or "" for i, t in rows}
    ids = {i: [*own.encode(t, add_special_tokens=False).ids, P.END_ID] for i, t in texts.items()}
    packed = P.sequences(docs(*rows).selectExpr("*", "1 as ids", "2 as slot", "3 as piece"))
    made = packed.collect()
    assert len({s["sequence_id"] for s in made}) == len(made)
    met = []
    for s in made:
        whole = np.frombuffer(s["ids"], "<u4").tolist()
        assert 0 < len(whole) <= P.WINDOW
        assert whole == [t for p in s["pieces"] for t in ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]]
        assert [p["offset"] for p in s["pieces"]] == np.cumsum([0, *[p["length"] for p in s["pieces"]]])[:-1].tolist()
        met += [(p["doc_id"], p["piece"], p["start"], p["length"]) for p in s["pieces"]]
    expected = []
    for i, _ in rows:
        n = len(ids[i])
        starts = [0, *range(n % 1024 or 1024, n, 1024)]
        expected += [(i, k, a, b - a) for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True))]
    assert sorted(met, key=repr) == sorted(expected, key=repr)
    told = P.places(packed).collect()
    assert len(told) == len(expected)
    for r in told:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    total = sum(len(ids[i]) for i, _ in rows)
    assert len(made) <= total // 1024 + 2


def test_full_partitions_are_packed_in_turns(docs, monkeypatch):
    monkeypatch.setattr(P, "PIECES_PER_TASK", 4)
    got = P.places(P.sequences(docs(*[(i, "word " * 50) for i in range(300)]))).toPandas()
    assert sorted(got["doc_id"]) == list(range(300))
    for _, mine in got.sort_values("offset").groupby("sequence_id"):
        assert (mine["offset"].to_numpy() == np.concatenate([[0], mine["length"].cumsum()[:-1]])).all()


def test_empty_table(docs):
    assert P.places(P.sequences(docs())).count() == 0
