"""Packing: ids against the tokenizer, places against the rules, the fit against a plain version."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing as P

TEXTS = ["", "a", "  two  spaces ", "line\nbreak \n end", "straße né ł ∑ 漢字 🙂", "don't 12'3 <|endoftext|>", "word " * 3000, "\n", " x", "x ", "tab\tand\x1cfile\x85next"]


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(P.TOKENIZER)


def whole(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_awkward_texts(encoder):
    for text, ids in zip(TEXTS, encoder.ids(TEXTS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(encoder, text), text


def test_added_tokens_are_those_of_the_tokenizer_as_it_is(encoder):
    own = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "a <|endoftext| > b", "plain words", *TEXTS]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(encoder.ids(texts)[0], "<u4").tolist() == [64, 220, 50256, 275]


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab Zé1'\n\t.,-ßĀ\x1c漢") | st.characters(max_codepoint=0x250)))
def test_ids_of_any_text(encoder, text):
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == whole(encoder, text)


@given(lengths=st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing_is_the_plain_one(lengths):
    sequence, offset = P.best_fit_decreasing(np.array(lengths, "i8"), 40)
    open_, plain = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [w for w in open_ if 40 - w[0] >= lengths[i]]
        window = min(fits, key=lambda w: 40 - w[0]) if fits else [0]
        if not fits:
            open_.append(window)
        plain[i] = window[0]
        window[0] += lengths[i]
    assert (sequence.max(initial=-1) + 1) == len(open_)
    for s in set(sequence.tolist()):
        mine = np.flatnonzero(sequence == s)
        ends = sorted((offset[k], offset[k] + lengths[k]) for k in mine)
        assert ends[0][0] == 0 and ends[-1][1] <= 40
        assert all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_pieces_cover_each_document_and_sequences_have_no_gaps(docs, encoder):
    rows = [*enumerate(TEXTS), (99, None), (None, "no id"), (6, TEXTS[6]), *[(100 + i, "some words " * (i * 13)) for i in range(60)]]
    got = P.pack(docs(*rows)).toPandas()
    assert got["doc_id"].isna().sum() == 1
    text = dict(enumerate(TEXTS)) | {99: "", **{100 + i: "some words " * (i * 13) for i in range(60)}}
    for doc_id, mine in got.dropna().groupby("doc_id"):
        ids = np.array([*whole(encoder, text[int(doc_id)]), P.END_ID], "<u4")
        copies = 2 if doc_id == 6 else 1
        assert len(mine) == copies * -(-len(ids) // P.WINDOW) and (mine["doc_tokens"] == len(ids)).all()
        assert mine["length"].sum() == copies * len(ids)
        for r in mine.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for _, mine in got.sort_values("offset").groupby("sequence_id"):
        assert (mine["offset"].to_numpy() == np.concatenate([[0], mine["length"].cumsum()[:-1]])).all()
        used = mine["length"].sum()
        assert used <= P.WINDOW and (mine["padded_length"] == (used if used & (used - 1) == 0 else P.WINDOW)).all()
    assert got["length"].sum() / P.WINDOW / got["sequence_id"].nunique() > 0.95


def test_sequences_hold_the_ids_of_their_pieces(docs, encoder, monkeypatch):
    rows = [*enumerate(TEXTS), (None, "no id"), *[(100 + i, "some words " * (i * 13)) for i in range(60)], *[(500, "copy " * 7)] * 40]
    text = {i: t for i, t in rows}
    ids = {i: [*whole(encoder, t), P.END_ID] for i, t in text.items()}
    expected = sum(len(ids[i]) for i, _ in rows)
    for most in (P.PIECES_PER_TASK, 10):  # also where copies overfill a partition
        monkeypatch.setattr(P, "PIECES_PER_TASK", most)
        got = P.sequences(docs(*rows)).collect()
        got = [{**s.asDict(), "ids": np.frombuffer(s["ids"], "<u4").tolist()} for s in got]
        assert sum(len(s["ids"]) for s in got) == expected and len({s["sequence_id"] for s in got}) == len(got)
        for s in got:
            assert len(s["ids"]) <= P.WINDOW
            assert s["ids"] == [t for p in s["pieces"] for t in ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]]
        packed = P.pack(docs(*rows))
        whole_ones = {tuple(r["sequence"]) for r in packed.where("offset = 0").collect()}
        assert sum(len(r["sequence"]) for r in packed.collect()) == expected
        if most == 10:
            continue
        assert whole_ones == {tuple(s["ids"]) for s in got}


def test_empty_table(docs):
    assert P.pack(docs()).count() == 0
