"""Reading dirty values: agreement with Python and pandas on probe strings."""

from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V

STRING, DOUBLE = T.StringType(), T.DoubleType()


def _each(spark, rows, layout, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {layout}")
    return [r["x"] for r in df.select("i", F.expr(expr).alias("x")).orderBy("i").collect()]


def test_blank_agrees_with_strip_on_every_character(spark):
    chars = [chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    got = _each(spark, chars, "string", V.is_blank("v", STRING))
    assert [c for c, g in zip(chars, got) if g] == [c for c in chars if c.strip() == ""]


def test_blank_of_text_and_numbers(spark):
    texts = [None, "", "  ", "\t\n ", " a ", "0"]
    assert _each(spark, texts, "string", V.is_blank("v", STRING)) == [True, True, True, True, False, False]
    numbers = [None, float("nan"), 0.0, float("inf")]
    assert _each(spark, numbers, "double", V.is_blank("v", DOUBLE)) == [True, True, False, False]


PROBES = [
    "1", "-1", "+1.5", ".5", "5.", "1e3", "1E-3", " 7 ", "0x10", "1d", "1f", "1,000", "1_000", "inf",
    "-Infinity", "nan", "", "abc", "1e400", "--1", "1 2", "1e", "٣", "$5",
]


def test_numbers_agree_with_pandas(spark):
    expected = pd.to_numeric(pd.Series(PROBES[:-2], dtype=object), errors="coerce")
    got = _each(spark, PROBES[:-2], "string", V.as_number("v", STRING))
    assert [None if pd.isna(e) else float(e) for e in expected] == got
    assert _each(spark, PROBES[-2:], "string", V.as_number("v", STRING))[1] is None


def test_dates_do_not_depend_on_the_order_of_formats_seen(spark):
    texts = ["1/26/2026", "2026-02-01", "2026-02-25T10:00:00Z", " 2026-02-03 ", "13/45/2026", "12:30", "2026", None]
    got = _each(spark, texts, "string", f"cast({V.as_timestamp('v', STRING)} as string)")
    assert got == [
        "2026-01-26 00:00:00", "2026-02-01 00:00:00", "2026-02-25 10:00:00", "2026-02-03 00:00:00",
        None, None, None, None,
    ]


def test_own_date_formats(spark):
    expr = V.as_timestamp("v", STRING, ("dd MMM yyyy", "yyyyMMdd", "dd.MM.yyyy"))
    got = _each(spark, ["03 Feb 2026", "20260204", "05.02.2026", "2026-02-01"], "string", f"cast({expr} as string)")
    assert got == ["2026-02-03 00:00:00", "2026-02-04 00:00:00", "2026-02-05 00:00:00", None]


def test_epoch_numbers_need_a_unit(spark):
    expr = V.as_timestamp("v", T.LongType(), unit="ms")
    assert _each(spark, [86_400_000, 2**62], "bigint", f"cast({expr} as string)")[0] == "1970-01-02 00:00:00"
    assert not V.can_be_moment(T.LongType())


def test_later_today_is_not_in_the_future(spark):
    expr = V.after_day("v", STRING, date(2026, 2, 26))
    got = _each(spark, ["2026-02-26 23:59:59", "2026-02-27", None, "x"], "string", expr)
    assert got == [False, True, True, True]


def test_doubles_and_booleans_are_written_like_python(spark):
    numbers = [1.0, 0.1, 1e8, 123456789.25, 0.0005, 12345678.9, 1e-4, 9999999.0, -2.5e9]
    assert _each(spark, numbers, "double", V.as_text("v", DOUBLE)) == [str(n) for n in numbers]
    assert _each(spark, [True, False], "boolean", V.as_text("v", T.BooleanType())) == ["True", "False"]


@pytest.mark.parametrize(
    ("layout", "kind", "rows", "allowed", "bad"),
    [
        ("bigint", T.LongType(), [1, 2, None], [1], [False, True, False]),
        ("bigint", T.LongType(), [1, 2], ["1", "2.0"], [False, True]),
        ("double", DOUBLE, [1.0, 1e8, float("nan")], [1, "100000000"], [False, False, False]),
        ("string", STRING, ["kg", "bad", " ", None], ["kg"], [False, True, False, False]),
        ("string", STRING, ["kg", None], [], [True, False]),
        ("boolean", T.BooleanType(), [True, False], [True], [False, True]),
        ("string", STRING, ["it's", "a\\b"], ["it's", "a\\b"], [False, False]),
    ],
)
def test_outside_an_allow_list(spark, layout, kind, rows, allowed, bad):
    assert _each(spark, rows, layout, V.outside("v", kind, allowed)) == bad


def test_keys_of_long_texts_are_short_and_distinct(spark):
    texts = ["x" * 64, "x" * 65, "x" * 66, "é" * 33, "short", None]
    keys = _each(spark, texts, "string", V.groupable("v", STRING))
    assert keys[0] == texts[0] and keys[4] == "short" and keys[5] is None
    assert len(set(keys)) == len(keys)
    assert all(k is None or len(k) <= 71 for k in keys)
