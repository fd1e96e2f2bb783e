"""Mergeable sketches: exact parts, estimates within their error, merging, replacing, and what is shuffled."""

from __future__ import annotations

import pytest

from plumbline.operators import sketches as S
from plumbline.operators.profile import profile


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(20000).selectExpr(
        "id as n", "id % 7 as few", "cast(if(id % 5 = 0, null, id / 3) as double) as d", "concat('t', id % 3000) as t",
        "if(id % 2 = 0, ' ', cast(null as string)) as blank", "cast(null as int) as none", "id % 2 = 0 as flag",
        "date_add(date'2024-01-01', cast(id % 4 as int)) as day", "cast('NaN' as float) as nan", "struct(id % 11 as x) as nested",
    )


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_a_sketched_profile_is_the_exact_one_but_for_distinct_counts(spark, table):
    exact, found = by_column(profile({"t": table})), by_column(S.profile_sketched(S.sketch("t", table, "day")))
    assert set(exact) == set(found)
    for name, e in exact.items():
        f = found[name]
        for c in ("ordinal", "dtype", "row_count", "null_count", "null_pct", "non_null_count", "min", "max"):
            assert f[c] == e[c], (name, c)
        assert f["mean"] == pytest.approx(e["mean"]) if e["mean"] is not None else f["mean"] is None
        assert abs(f["distinct_count"] - e["distinct_count"]) <= max(1, 4 * S.standard_error() * e["distinct_count"]), name
        assert 0 <= f["distinct_ratio_non_null"] <= 1 and f["duplicate_count"] >= 0


def test_days_are_merged_in_any_order_and_replaced(spark, table, tmp_path):
    folder = str(tmp_path / "sketches")
    whole = by_column(S.profile_sketched(S.sketch("t", table)))
    S.store(S.sketch("t", table.where("n < 5"), "day"), folder)
    for day in ("'2024-01-04'", "'2024-01-01'", "'2024-01-02'", "'2024-01-03'"):
        S.store(S.sketch("t", table.where(f"day = date{day}"), "day"), folder)
    kept = S.stored(spark, folder)
    assert kept.count() == 4 * len(table.columns)
    in_steps = S.merge(S.merge(kept.where("part < '2024-01-03'")).unionByName(kept.where("part >= '2024-01-03'")))
    once, steps = by_column(S.profile_sketched(kept)), by_column(S.profile_sketched(in_steps))
    for c, r in whole.items():
        assert once[c]["row_count"] == steps[c]["row_count"] == 20000
        for found in (once, steps):
            assert abs(found[c]["distinct_count"] - r["distinct_count"]) <= 4 * S.standard_error() * r["distinct_count"]
    assert {r["part"] for r in S.stored(spark, folder, ["2024-01-02"]).collect()} == {"2024-01-02"}


def test_only_near_unique_columns_are_counted(spark, table):
    sketched = S.profile_sketched(S.sketch("t", table.select("n", "few", "t", "none")))
    assert [r["column"] for r in S.near_unique(sketched).collect()] == ["n"]
    found = by_column(S.exact_where_it_matters(sketched, {"t": table}))
    assert (found["n"]["distinct_count"], found["n"]["max_dup_count"], found["n"]["exact"]) == (20000, 1, True)
    assert not found["t"]["exact"] and found["t"]["max_dup_count"] is None
    none = S.profile_sketched(S.sketch("t", table.select("few")))
    assert not by_column(S.exact_where_it_matters(none, {"t": table}))["few"]["exact"]


def test_no_value_is_shuffled(spark, table):
    """What leaves a task is a row per part, however many values it has seen."""
    some = S.sketch("t", table.select("n", "t", "day").repartition(4), "day")
    plan = some._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("hashpartitioning(__part" in line for line in exchanges)


def test_empty_table(spark, table, tmp_path):
    assert S.profile_sketched(S.sketch("t", table.limit(0), "day")).count() == 0
    assert S.profile_sketched(S.stored(spark, str(tmp_path))).count() == 0
