"""WARC: exact round trip, merge against a plain sort."""

import base64
import hashlib
import io

from hypothesis import given
from hypothesis import strategies as st

from plumbline.llm import warc as W

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a.example.com/x", "<p>one</p>"),
    (2, "http://b.example.com/y?q=1", "<p>two</p>"),
    (3, "https://A.example.com:8080/X#frag", "<p>one</p>"),
    (4, None, None),
    (5, "http://b.example.com/a b\r\nc", ""),
    (6, "http://c.example.com/", "multi\r\n\r\nline\r\n\r\nWARC/1.1\r\n\r\n ünï 漢 🙂 " + "long " * 30000),
    (7, "http://a.example.com/x", "<p>one</p>"),
    (None, "http://n.example.com/", "<p>two</p>"),
]


def test_round_trip(spark):
    got = W.round_trip(spark.createDataFrame(ROWS, PAGES).withColumnRenamed("x", "digest")).collect()
    assert len(got) == len(ROWS)
    keys = [(r["url_key"], r["captured_at"], -1 if r["page_id"] is None else r["page_id"]) for r in got]
    assert keys == sorted(keys)
    by_id = {r["page_id"]: r for r in got}
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        assert by_id[page_id]["payload_bytes"] == len(data)
        assert by_id[page_id]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    told = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got}
    assert told[1] == told[3] == ("revisit", 7) and told[7] == ("response", None)
    assert told[4] == ("revisit", 5) and told[5] == ("response", None)
    assert told[None] == ("revisit", 2) and told[2] == told[6] == ("response", None)


def test_repeated_rows_extra_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "u", "h", 9, "z"), (1, "u", "h", 9, "z")], PAGES + ", size long, digest string")
    assert [r["record_type"] for r in W.round_trip(frame).collect()] == ["response"] * 2
    assert W.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_damaged_archives_are_noticed():
    import pytest

    with pytest.raises(ValueError):
        list(W.parsed(io.BytesIO(b"nonsense\r\n")))


@given(runs=st.lists(st.lists(st.integers(0, 9), max_size=6), max_size=9))
def test_loser_tree_merges_like_a_sort(runs):
    rows = [iter([(x, k, i) for i, x in enumerate(sorted(r))]) for k, r in enumerate(runs)]
    merged = list(W.LoserTree(rows, lambda r: r[0]))
    assert merged == sorted(((x, k, i) for k, r in enumerate(runs) for i, x in enumerate(sorted(r))), key=lambda r: (r[0], r[1]))


def test_url_keys():
    assert W.url_key("HTTPS://Www.Example.com:80/A?b=C#d") == "com,example,www)/a?b=c"
    assert W.url_key("") == ")"
