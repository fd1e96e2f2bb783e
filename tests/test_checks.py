"""One test per check, on tiny frames; payloads as they are stored."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from plumbline.model import Rule, RuleSet
from plumbline.operators.checks import Clock
from plumbline.operators.profile import profile
from plumbline.plans import ruleset_run as R

AS_OF = datetime(2026, 2, 26)


def run(spark, datasets, rule_type, as_of=AS_OF, dataset="d", **expectation):
    rule = Rule("X001", rule_type, "high", expectation)
    ruleset = RuleSet(dataset, 1, (rule,))
    row = R.measure(spark, [ruleset], datasets, as_of).first()
    return row["status"], json.loads(row["observed_value"]), json.loads(row["threshold"])


def bad_rows(spark, datasets, rule_type, **expectation):
    planned = R.plan([RuleSet("d", 1, (Rule("X001", rule_type, "high", expectation),))], datasets, Clock.at(AS_OF))
    rows = R.violations(planned[0].checks[0], datasets).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "d": spark.createDataFrame(
            [(31, "oak", 4.5, "1/26/2026", "M1"), (31, "tin", 17.25, "2026-03-03", "M2"), (58, None, -6.0, "x", " "),
             (None, "  ", None, None, None), (None, "tin", float("nan"), "2/26/2026", "M9")],
            "id int, u string, x double, day string, fk string",
        ),
        "parent": spark.createDataFrame([("M1",), ("M1",), (None,)], "k string"),
        "empty": spark.createDataFrame([], "id int, u string, ts string"),
    }


def test_schema(spark, frames):
    status, observed, threshold = run(spark, frames, "schema", required_columns=["id", "ID", "ts"])
    assert status == "fail"
    assert observed == {"missing_columns": ["ID", "ts"], "required_columns": ["id", "ID", "ts"]}
    assert threshold == {"required_columns": ["id", "ID", "ts"]}
    assert run(spark, frames, "schema")[0] == "pass"


def test_completeness(spark, frames):
    assert run(spark, frames, "completeness", column="u") == (
        "fail", {"null_count": 2, "total": 5, "null_pct": 40.0}, {"max_null_percent": 0.0},
    )
    assert run(spark, frames, "completeness", column="u", max_null_percent=40)[0] == "pass"
    assert run(spark, frames, "completeness", dataset="empty", column="u") == (
        "pass", {"null_count": 0, "total": 0, "null_pct": 0.0}, {"max_null_percent": 0.0},
    )


def test_uniqueness_counts_nulls_as_one_value(spark, frames):
    assert run(spark, frames, "uniqueness", column="id") == (
        "fail", {"duplicate_keys": [None, "31"], "duplicates": 2, "total": 5}, {"max_duplicates_allowed": 0},
    )
    assert run(spark, frames, "uniqueness", column="id", max_duplicates_allowed=2)[0] == "pass"
    # every row of a repeated group is a bad row
    assert [r[0] for r in bad_rows_sorted(spark, frames)] == [None, None, 31, 31]


def bad_rows_sorted(spark, frames):
    planned = R.plan([RuleSet("d", 1, (Rule("U", "uniqueness", "high", {"column": "id"}),))], frames, Clock.at(AS_OF))
    return R.violations(planned[0].checks[0], frames).orderBy("id").collect()


def test_uniqueness_of_nan_and_null(spark, frames):
    assert run(spark, frames, "uniqueness", column="x")[1]["duplicates"] == 1


def test_range(spark, frames):
    assert run(spark, frames, "range", column="x", min=0) == (
        "fail", {"failed": 3, "total": 5}, {"min": 0, "max": None},
    )
    assert run(spark, frames, "range", column="x")[1]["failed"] == 2
    assert run(spark, frames, "range", column="u")[1]["failed"] == 5


def test_domain(spark, frames):
    assert run(spark, frames, "domain", column="u", allowed_values=["oak", "elm"]) == (
        "fail",
        {"failed": 2, "total": 5, "top_invalid_values": {"tin": 2}},
        {"allowed_values": ["elm", "oak"]},
    )
    assert run(spark, frames, "domain", column="u")[1]["failed"] == 3
    assert run(spark, frames, "domain", column="id", allowed_values=[31, 58])[0] == "pass"


def test_domain_with_a_mixed_list_is_an_error(spark, frames):
    status, observed, threshold = run(spark, frames, "domain", column="u", allowed_values=["oak", 1])
    assert (status, observed["error"]) == ("fail", "bad_parameter")
    assert threshold == {"column": "u", "allowed_values": ["oak", 1]}


def test_date_not_in_future(spark, frames):
    assert run(spark, frames, "date_not_in_future", column="day") == (
        "fail", {"failed": 3, "total": 5, "today": "2026-02-26"}, {"not_in_future": True},
    )
    assert run(spark, frames, "date_not_in_future", column="id")[1]["error"] == "bad_parameter"


def test_referential_integrity(spark, frames):
    parts = {"child_column": "fk", "parent_dataset": "parent", "parent_column": "k"}
    assert run(spark, frames, "referential_integrity", **parts) == (
        "fail",
        {"failed": 2, "total": 5, "top_missing_parent_keys": {"M2": 1, "M9": 1}},
        {"parent_column": "k"},
    )
    rows = bad_rows(spark, frames, "referential_integrity", **parts)
    assert sorted(r[4] for r in rows) == ["M2", "M9"]


def test_referential_integrity_compares_types_alike(spark):
    frames = {
        "d": spark.createDataFrame([(1,), (2,), (None,)], "k int"),
        "doubles": spark.createDataFrame([(1.0,), (3.0,)], "k double"),
        "texts": spark.createDataFrame([("1",), ("2.0",)], "k string"),
        "longs": spark.createDataFrame([(1,), (2,)], "k bigint"),
    }
    failed = {
        p: run(spark, frames, "referential_integrity", child_column="k", parent_dataset=p, parent_column="k")[1]["failed"]
        for p in ("doubles", "texts", "longs")
    }
    assert failed == {"doubles": 1, "texts": 1, "longs": 0}


def test_child_dataset_is_honoured(spark, frames):
    status, observed, _ = run(
        spark, frames, "referential_integrity", dataset="parent", child_dataset="d", child_column="fk",
        parent_dataset="parent", parent_column="k",
    )
    assert (status, observed["failed"], observed["total"]) == ("fail", 2, 5)


def test_freshness(spark):
    frames = {"d": spark.createDataFrame([("2/26/2026",), ("x",)], "ts_load string")}
    status, observed, threshold = run(spark, frames, "freshness", max_age_days=10, as_of=datetime(2026, 12, 1))
    assert status == "fail"
    assert observed == {
        "max_ts_load_utc": "2026-02-26 00:00:00+00:00", "now_utc": "2026-12-01 00:00:00+00:00", "age_days": 278.0,
    }
    assert threshold == {"max_age_days": 10, "ts_column": "ts_load"}
    assert run(spark, frames, "freshness", max_age_days=0)[0] == "pass"
    assert run(spark, frames, "freshness", max_age_days=0, as_of=datetime(2026, 1, 1))[0] == "pass"
    assert run(spark, frames, "freshness", column="ts_load", max_age_days=0)[0] == "pass"


def test_freshness_without_an_answer(spark, frames):
    status, observed, _ = run(spark, frames, "freshness", ts_column="u")
    assert status == "fail" and observed["error"].startswith("Incorrect Freshness requirement")
    assert run(spark, frames, "freshness", max_age_days=1)[1] == {"error": "missing_ts_column", "ts_column": "ts_load"}
    assert run(spark, frames, "freshness", ts_column="ts", dataset="empty", max_age_days=1)[1] == {
        "error": "ts_column_not_parseable_or_all_null", "ts_column": "ts",
    }


def test_freshness_keeps_microseconds(spark):
    frames = {"d": spark.createDataFrame([(datetime(2026, 2, 25, 12, 0, 0, 250),)], "t timestamp_ntz")}
    observed = run(spark, frames, "freshness", ts_column="t", max_age_days=1)[1]
    assert observed["max_ts_load_utc"] == "2026-02-25 12:00:00.000250+00:00"
    assert observed["age_days"] == 0.5


@pytest.mark.parametrize(
    ("rule_type", "expectation", "error"),
    [
        ("sorted", {}, "unknown_rule_type"),
        ("completeness", {}, "bad_parameter"),
        ("completeness", {"column": "nope"}, "missing_column"),
        ("completeness", {"column": "ID"}, "missing_column"),
        ("completeness", {"column": "id", "max_null_percent": "many"}, "bad_parameter"),
        ("range", {"column": "id", "min": "low"}, "bad_parameter"),
        ("referential_integrity", {"child_column": "id", "parent_dataset": "gone", "parent_column": "k"}, "missing_dataset"),
        ("freshness", {"ts_column": "u", "max_age_days": "old"}, "bad_parameter"),
    ],
)
def test_a_broken_rule_is_one_failed_row(spark, frames, rule_type, expectation, error):
    rules = (Rule("A", rule_type, "low", expectation), Rule("B", "completeness", "low", {"column": "id"}))
    rows = R.measure(spark, [RuleSet("d", 1, rules)], frames, AS_OF).orderBy("seq").collect()
    assert [r["status"] for r in rows] == ["fail", "fail"]
    assert json.loads(rows[0]["observed_value"])["error"] == error
    assert json.loads(rows[1]["observed_value"])["null_count"] == 2


def test_odd_column_names(spark):
    frames = {"d": spark.createDataFrame([(1, "a"), (1, None)], "`a.b` int, `it's ``x``` string")}
    assert run(spark, frames, "uniqueness", column="a.b")[1]["duplicates"] == 1
    assert run(spark, frames, "completeness", column="it's `x`")[1]["null_count"] == 1


def test_long_texts_are_shown_whole(spark):
    long = "word " * 5000
    frames = {"d": spark.createDataFrame([(long,), (long,), ("b",), (long + "x",)], "t string")}
    assert run(spark, frames, "uniqueness", column="t")[1]["duplicate_keys"] == [long]
    assert run(spark, frames, "domain", column="t", allowed_values=["b"])[1]["top_invalid_values"] == {long: 2, long + "x": 1}


def test_ties_of_frequent_values_go_by_value(spark):
    frames = {"d": spark.createDataFrame([(c,) for c in "hgfedcbaaijklmn"], "t string")}
    top = run(spark, frames, "domain", column="t")[1]["top_invalid_values"]
    assert list(top.items()) == [("a", 2)] + [(c, 1) for c in "bcdefghij"]


BIG = 9007199254740992  # the first whole number whose successor no double can hold


def test_large_whole_numbers_and_decimals_are_compared_exactly(spark):
    from decimal import Decimal

    frames = {
        "d": spark.createDataFrame([(BIG + 1, Decimal(BIG + 1), 1234567890123456789)], "n bigint, m decimal(20,0), k bigint"),
        "parent": spark.createDataFrame([(Decimal(BIG),)], "m decimal(20,0)"),
    }
    for column in "nm":
        assert run(spark, frames, "range", column=column, max=BIG)[0] == "fail"
        assert run(spark, frames, "range", column=column, max=BIG + 1, min=str(BIG + 1))[0] == "pass"
        assert run(spark, frames, "range", column=column, min=float("-inf"), max=1e300)[0] == "pass"
        assert run(spark, frames, "range", column=column, min=float("inf"))[0] == "fail"
        assert run(spark, frames, "domain", column=column, allowed_values=[BIG])[0] == "fail"
        assert run(spark, frames, "domain", column=column, allowed_values=[BIG + 1])[0] == "pass"
    assert run(spark, frames, "range", column="n", min=BIG + 0.5)[0] == "pass"
    assert run(spark, frames, "domain", column="k", allowed_values=[1234567890123456789])[0] == "pass"
    parts = {"child_column": "n", "parent_dataset": "parent", "parent_column": "m"}
    assert run(spark, frames, "referential_integrity", **parts)[1]["failed"] == 1


def test_floats_are_compared_as_floats(spark):
    frames = {"d": spark.sql("select cast(x as float) as f from values ('0.1'), ('0.2'), ('NaN'), (null) t(x)")}
    assert run(spark, frames, "domain", column="f", allowed_values=[0.1, 0.2])[0] == "pass"
    assert run(spark, frames, "domain", column="f", allowed_values=[0.1])[1]["top_invalid_values"] == {"0.2": 1}
    assert run(spark, frames, "range", column="f", min=0.1, max=0.2)[1]["failed"] == 2
    assert run(spark, frames, "range", column="f", min=0.15, max=1e300)[1]["failed"] == 3


WIDE = [
    ("decimal(38,0)", "9007199254740993", "decimal(38,20)", "9007199254740992"),
    ("decimal(38,0)", "9007199254740993", "decimal(38,10)", "9007199254740992"),
    ("bigint", "9007199254740993", "double", "9007199254740992"),
    ("double", "0.5", "bigint", "0"),
    ("decimal(38,20)", "0.00000000000000000001", "double", "0"),
    ("double", "1e20", "decimal(38,0)", "100000000000000000001"),
]


@pytest.mark.parametrize("child, value, parent, other", WIDE)
def test_numbers_without_a_common_type_are_told_apart(spark, child, value, parent, other):
    def made(kind, *texts):
        return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"cast(t as {kind}) as n")

    parts = {"child_column": "n", "parent_dataset": "parent", "parent_column": "n"}
    frames = {"d": made(child, value, None), "parent": made(parent, other, None)}
    assert run(spark, frames, "referential_integrity", **parts)[1]["failed"] == 1
    equal = other if child in ("bigint", "decimal(38,0)") or value == "0.5" else "100000000000000000000" if value == "1e20" else "0"
    frames = {"d": made(child, equal, "-7"), "parent": made(parent, equal, "-7", "5")}
    assert run(spark, frames, "referential_integrity", **parts)[0] == "pass"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_moments_do_not_depend_on_the_zone_of_the_session(spark, zone):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frames = {
            "d": spark.sql("""select '2024-02-01 00:00:00' as t, '2/1/2024 0:00' as f, '2024-01-31T19:00:00-05:00' as z,
                              timestamp_ntz'2024-02-01 00:00:00' as n, date'2024-02-01' as a, timestamp_micros(1706745600000000) as l"""),
            "twice": spark.sql("select explode(array(1699162200000000, 1699165800000000, 1699165800000000)) as u").selectExpr("timestamp_micros(u) as l"),
            "none": spark.createDataFrame([], "l timestamp"),
        }
        clock = {"as_of": datetime(2024, 2, 5)}
        for column in "tfznal":
            status, observed, _ = run(spark, frames, "freshness", ts_column=column, max_age_days=4, **clock)
            assert (status, observed["age_days"], observed["max_ts_load_utc"]) == ("pass", 4.0, "2024-02-01 00:00:00+00:00")
            assert run(spark, frames, "date_not_in_future", column=column, as_of=datetime(2024, 1, 31, 23))[0] == "fail"
            assert run(spark, frames, "date_not_in_future", column=column, as_of=datetime(2024, 2, 1))[0] == "pass"
        # two moments that a clock set back shows alike
        found = run(spark, frames, "referential_integrity", dataset="twice", child_column="l", parent_dataset="none", parent_column="l")
        assert found[1]["top_missing_parent_keys"] == {"2023-11-05 06:30:00": 2, "2023-11-05 05:30:00": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


@pytest.mark.parametrize("length", [60, 200, 201, 300])
@pytest.mark.parametrize("end", [False, True])
def test_ties_of_texts_of_any_length_go_by_value(spark, length, end):
    texts = [("x" * (length - 1) + c if end else c + "x" * (length - 1)) for c in "cab"]
    frames = {"d": spark.createDataFrame([(t,) for t in texts * 2], "t string")}
    assert run(spark, frames, "uniqueness", column="t")[1]["duplicate_keys"] == sorted(texts)


def test_of_many_long_texts_that_begin_alike_the_first_by_value_are_shown(spark):
    """More keys tie at the cut than are shown; other frequencies and short texts are among them."""
    head = "y" * 200
    texts = [f"{head}{n:03d}" for n in range(60)]
    rows = [*texts * 2, *[head] * 2, *["z"] * 5, *[f"{head}often {c}" for c in "ba"] * 3, f"{head}once", "a", "a"]
    frames = {"d": spark.createDataFrame([(t, i % 7) for i, t in enumerate(rows)], "t string, k int").repartition(5)}
    expected = ["z", f"{head}often a", f"{head}often b", "a", head, *texts][:20]
    assert run(spark, frames, "uniqueness", column="t")[1]["duplicate_keys"] == expected
    top = run(spark, frames, "domain", column="t", allowed_values=["z"])[1]["top_invalid_values"]
    assert list(top) == expected[1:11]
    for row_formats in ((), ("d",)):
        listed = {r["column"]: [e["value"] for e in r["top_values"]] for r in profile(frames, row_formats=row_formats).collect()}
        assert listed["t"] == expected[:10] and sorted(listed["k"]) == [str(n) for n in range(7)]


def test_long_binary_keys_are_short(spark):
    df = spark.sql("select unhex(repeat('ab', 10000)) as b from range(2)")
    assert run(spark, {"d": df}, "uniqueness", column="b")[1]["duplicates"] == 1
    both = df.selectExpr("b", "repeat('t', 300) as t")
    assert len(run(spark, {"d": both}, "uniqueness", column="b")[1]["duplicate_keys"]) == 1
    assert run(spark, {"d": both}, "uniqueness", column="t")[1]["duplicate_keys"] == ["t" * 300]
    from plumbline.operators import value_counts as C

    assert len(C.value_counts(df, "b").first()["key"]) == 232
