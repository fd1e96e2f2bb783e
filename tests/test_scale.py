"""Skewed keys, and the plans that are meant to carry large tables."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from plumbline.functions import values as V
from plumbline.model import Rule, RuleSet
from plumbline.operators import value_counts as C
from plumbline.operators.checks import Clock
from plumbline.operators.profile import profile
from plumbline.plans import ruleset_run as R

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, some keys are repeated, most are not."""
    rows = [("hot", i) for i in range(1000)] + [(f"k{i % 1500}", i) for i in range(2000)] + [(None, 1), (None, 2)]
    return spark.createDataFrame(rows, "k string, v int").repartition(6)


@pytest.mark.parametrize("hot_keys", [1000, 1, 3])
def test_rows_of_repeated_keys(spark, skewed, hot_keys, monkeypatch):
    monkeypatch.setattr(C, "HOT_KEYS", hot_keys)
    rows = C.rows_with_keys(skewed, V.groupable("k", skewed.schema["k"].dataType), C.repeated_keys(skewed, "k"))
    all_rows = [tuple(r) for r in skewed.collect()]
    keys = [k for k, _ in all_rows]
    repeated = {k for k in set(keys) if keys.count(k) > 1}
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted((r for r in all_rows if r[0] in repeated), key=repr)
    assert rows.columns == ["k", "v"]


def test_rows_of_hot_keys_are_not_shuffled(spark, skewed):
    key = V.groupable("k", skewed.schema["k"].dataType)
    plan = text(C.rows_with_keys(skewed, key, C.repeated_keys(skewed, "k")))
    physical = plan[plan.index("== Physical Plan =="):]
    shuffled = physical[physical.index("SortMergeJoin"):]
    left = shuffled[shuffled.index("Exchange hashpartitioning(coalesce(__key"):]
    assert left.index("LeftAnti") < left.index("Scan")  # hot rows leave before the exchange


def test_orphans_of_a_hot_key_are_joined_once_per_key(spark, skewed):
    parent = spark.createDataFrame([(f"k{i}",) for i in range(700)] * 3, "k string")
    found = {r["key"]: r["n"] for r in C.orphan_keys(skewed, "k", parent, "k").collect()}
    assert found["hot"] == 1000 and len(found) == 801 and None not in found
    plan = text(C.orphan_keys(skewed, "k", parent, "k"))
    join = plan.index("LeftAnti")
    assert plan.count("HashAggregate", join) >= 4  # both sides are grouped below the join


@pytest.mark.parametrize("hashes", [C.BROADCAST_HASHES, 3])
def test_repeated_keys_by_hash_are_those_by_value(spark, skewed, hashes, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_HASHES", hashes)
    long_ = skewed.selectExpr("if(v % 3 = 0, k, concat(repeat('t', 300), v)) as k", "v")
    for df in (skewed, long_, skewed.limit(0)):
        found = {(r["key"], r["n"]) for r in C.repeated_keys_by_hash(df, "k").collect()}
        assert found == {(r["key"], r["n"]) for r in C.repeated_keys(df, "k").collect()}


def test_only_rows_of_repeated_hashes_are_counted_by_key(spark):
    df = spark.range(50000).selectExpr("concat(repeat('t', 300), if(id < 49990, id, 7)) as k")
    plan = final_plan(C.repeated_keys_by_hash(df, "k"))
    below = plan[plan.index("Exchange hashpartitioning(key"):]
    assert "BroadcastHashJoin" in below and "LeftSemi" in below  # what is exchanged has passed the filter
    assert "SortMergeJoin" not in plan
    assert C.repeated_keys_by_hash(df, "k").first()["n"] == 11


def text(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_row_rules_share_one_pruned_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    rules = [Rule(f"R{i}", "range", "low", {"column": "o_totalprice", "min": i}) for i in range(20)]
    rules += [Rule("C1", "completeness", "low", {"column": "o_orderpriority"}),
              Rule("T1", "date_not_in_future", "low", {"column": "o_orderdate"}),
              Rule("F1", "freshness", "low", {"ts_column": "o_orderdate", "max_age_days": 1})]
    plan = final_plan(R.measure(spark, [RuleSet("orders", 1, tuple(rules))], {"orders": orders}, datetime(2024, 1, 1)))
    assert plan.count("FileScan") == 1
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "o_orderpriority" in schema and "o_custkey" not in schema
    assert "Python" not in plan


def test_counts_are_computed_once_for_all_their_uses(spark):
    lineitem = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    rules = (Rule("U1", "uniqueness", "low", {"column": "l_orderkey"}), Rule("U2", "uniqueness", "high", {"column": "l_orderkey"}))
    plan = final_plan(R.measure(spark, [RuleSet("lineitem", 1, rules)], {"lineitem": lineitem}))
    assert plan.count("FileScan") == 2  # the row count and the counts by key
    assert "ReusedExchange" in plan


def _reference(rule_id, child, parent_dataset, parent, **more):
    expectation = {"child_column": child, "parent_dataset": parent_dataset, "parent_column": parent, **more}
    return Rule(rule_id, "referential_integrity", "low", expectation)


def test_rules_on_the_same_keys_share_one_shuffle(spark):
    datasets = {name: spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("lineitem", "orders")}
    datasets["some"] = datasets["orders"].where("o_orderkey % 2 = 0")
    rules = (Rule("U", "uniqueness", "low", {"column": "l_orderkey"}),
             _reference("K1", "l_orderkey", "orders", "o_orderkey"), _reference("K2", "l_orderkey", "some", "o_orderkey"),
             Rule("D", "domain", "low", {"column": "l_returnflag", "allowed_values": ["A"]}))
    own = RuleSet("orders", 1, (Rule("U", "uniqueness", "low", {"column": "o_orderkey"}),))
    plan = final_plan(R.measure(spark, [RuleSet("lineitem", 1, rules), own], datasets))
    assert "LeftAnti" not in plan  # keys meet in the count
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(key#" in line and "Reused" not in line]
    assert len(exchanges) == 1
    # totals and frequent values: two readers of the keys, for texts too, and what is sorted has passed the bound
    assert len([line for line in plan.splitlines() if "ReusedExchange" in line and "hashpartitioning(key#" in line]) == 1
    limited = plan[plan.index("WindowGroupLimit"):]
    assert limited.index("Sort") < limited.index("BroadcastHashJoin") < limited.index("hashpartitioning(key#")


@pytest.mark.parametrize("counts", [8, 3, 1])
def test_counts_in_families_are_those_of_each_rule(spark, monkeypatch, counts):
    """Nulls, blanks, ties, a column that refers to itself, other types, hashes: as counted rule by rule."""
    monkeypatch.setattr(R, "COUNTS_PER_KEY", counts)
    d = spark.range(6000).repartition(5).selectExpr(
        "if(id % 97 = 0, null, id * 31 % 2000) as k", "if(id % 50 = 0, '  ', cast(id % 3000 as string)) as t",
        "if(id % 40 = 0, double('NaN'), id % 700) as f", "cast(id % 900 as int) as i",
    )
    p = spark.range(1500).selectExpr("if(id = 3, null, id) as k", "cast(id as string) as t", "cast(id as int) as i", "cast(id div 2 as double) as f")
    datasets = {"d": d, "p": p, "none": p.limit(0)}
    rules = [Rule(f"U{c}", "uniqueness", "low", {"column": c}) for c in "ktfi"]
    rules += [Rule("H", "uniqueness", "low", {"column": "k", "count_by": "hash"})]
    rules += [_reference(f"K{c}{parent}", c, parent, c) for c in "ktfi" for parent in ("p", "none")]
    rules += [_reference("K1", "k", "p", "i"), _reference("K2", "k", "p", "t"), _reference("K3", "i", "d", "k"), _reference("K4", "i", "d", "i")]
    rules += [Rule("U2", "uniqueness", "low", {"column": "k"}), Rule("D", "domain", "low", {"column": "t", "allowed_values": ["1"]})]
    own = RuleSet("p", 1, tuple(Rule(f"P{c}", "uniqueness", "low", {"column": c}) for c in "kti"))
    planned = R.plan([RuleSet("d", 1, tuple(rules)), own], datasets, Clock.at())
    branches = R._branches(planned)
    found = {r["branch"]: r for r in R._counted(planned, datasets, branches).collect()}
    for part in planned:
        for check in part.checks:
            if check.grouping.kind == "invalid":
                continue
            keys, _, kind = R.keys_of(check.grouping, datasets[check.dataset], datasets)
            plain = [(r["value"], r["n"]) for r in C.key_texts(keys, 0, kind).collect()]
            got = found.get(branches[R._branch_key(check)])
            if not plain:
                assert got is None, check.rule.rule_id
                continue
            assert (got["rows"], got["surplus"], got["keys"]) == (sum(n for _, n in plain), sum(n - 1 for _, n in plain), len(plain))
            ordered = sorted(plain, key=lambda e: (-e[1], e[0] is not None, e[0]))[: R.TOP_KEYS]
            assert [tuple(e) for e in got["top"]] == ordered, check.rule.rule_id


@pytest.mark.parametrize("limit", [1, 7, 500])
def test_top_rows_by_level_are_the_top_rows(spark, limit):
    counted = spark.range(3000).selectExpr("cast(id % 3 as int) as branch", "if(id < 3, null, cast(id * 7919 % 3001 as string)) as value", "1 + id % (2 + id % 3 * 20) as n")
    found = C.top_rows_by_level(counted, C.levels(counted), limit)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, C.top_rows(counted, limit).collect()), key=repr)
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(C.totals_of_levels(C.levels(counted))) == order(C.totals(counted))


def test_frequent_values_are_pruned_before_the_shuffle(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rules = (Rule("U1", "uniqueness", "low", {"column": "text"}), Rule("U2", "uniqueness", "low", {"column": "doc_id"}))
    several = text(R.measure(spark, [RuleSet("documents", 1, rules)], {"documents": documents}))
    assert "WindowGroupLimit" in several
    single = text(R.measure(spark, [RuleSet("documents", 1, rules[:1])], {"documents": documents}))
    assert f"TakeOrderedAndProject(limit={C.TIED}" in single  # more than are shown, for ties
    bad = tuple(Rule(f"R{n}", "range", "low", {"column": "n_chars", "max": n}) for n in range(2))
    for rules, wanted in ((bad[:1], "TakeOrderedAndProject(limit=100"), (bad, "WindowGroupLimit")):
        planned = R.plan([RuleSet("documents", 1, rules)], {"documents": documents}, Clock.at())
        assert wanted in text(R.sample(planned, {"documents": documents}))


def test_profile_reads_each_column_twice_at_most(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    plan = final_plan(profile({"orders": orders}))
    assert plan.count("FileScan") == 4  # one for all statistics, one per column for its counts
    assert plan.count("ReusedExchange") >= 3
    assert "Python" not in plan


def test_violations_push_their_filter_into_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    planned = R.plan([RuleSet("o", 1, (Rule("T", "date_not_in_future", "low", {"column": "o_orderdate"}),
                                       Rule("R", "range", "low", {"column": "o_totalprice", "max": 5})))],
                     {"o": orders}, Clock.at(datetime(2000, 1, 1)))
    for check, column in zip(planned[0].checks, ("o_orderdate", "o_totalprice")):
        plan = final_plan(R.violations(check, {"o": orders}))
        pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
        assert column in pushed


def test_long_texts_do_not_travel(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = text(C.repeated_keys(documents, "text"))
    physical = plan[plan.index("== Physical Plan =="):]
    exchange = physical[physical.index("Exchange hashpartitioning"):]
    assert "sha2" in exchange and exchange.index("key#") < exchange.index("sha2")


def test_samples_of_several_rules_are_the_first_rows(spark, monkeypatch):
    """Bounds from some of the rows change nothing, with nulls, ties, and rules of few bad rows."""
    df = spark.range(60000).repartition(5).selectExpr(
        "if(id % 1000 = 7, null, (id * 7919) % 60000 div 3) as k", "id as n", "if(id < 40, null, id) as few", "id % 2 as half"
    )
    rules = tuple(
        Rule(f"C{i}", "range", "low", {"column": c, "min": low}) for i, (c, low) in enumerate([("n", 59000), ("half", 1), ("few", 0)])
    )
    planned = R.plan([RuleSet("d", 1, rules)], {"d": df}, Clock.at())
    for share in (0.0, 1 / 4, 1.0):
        monkeypatch.setattr(R, "BOUND_SHARE", share)
        for order in (["k", "n"], ["n"]):
            found = R.sample(planned, {"d": df}, order_by={"d": order}, max_samples=30)
            payloads = {}
            for r in found.orderBy("rule_id", "position").collect():
                payloads.setdefault(r["rule_id"], []).append(json.loads(r["payload"])["n"])
            for i, bad in enumerate(["n < 59000", "half < 1", "few is null"]):
                plain = [r["n"] for r in df.where(bad).orderBy(*order).limit(30).collect()]
                assert payloads[f"C{i}"] == plain, (share, order, i)


def test_only_rows_up_to_the_bound_are_ordered(spark):
    df = spark.range(400000).selectExpr("(id * 7919) % 400000 as k", "id % 2 as half")
    rules = tuple(Rule(f"C{i}", "range", "low", {"column": "half", "min": 1 - i / 2}) for i in range(2))
    planned = R.plan([RuleSet("d", 1, rules)], {"d": df}, Clock.at())
    found = R.sample(planned, {"d": df}, max_samples=20)
    assert found.count() == 40
    sorted_rows = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in sorted_rows
    # the plan below the sort: of 400,000 bad rows only those up to the bounds pass the filter
    tags = "explode(array(struct(0 as seq), struct(1 as seq))) as `__tag`"
    bounds = R._bounds(df.where("half < 1").selectExpr(tags, "k as `__key`"), 20).collect()
    assert len(bounds) == 2 and all(b["__bound"] < 40000 for b in bounds)


VALUE_RULES = (
    Rule("U", "uniqueness", "low", {"column": "k"}),
    Rule("K", "referential_integrity", "low", {"child_column": "k", "parent_dataset": "p", "parent_column": "k"}),
    Rule("F", "uniqueness", "low", {"column": "few"}),
    Rule("N", "uniqueness", "low", {"column": "none"}),
)


def _value_rows(spark):
    """Repeated keys and orphans with nulls and ties, rules of few bad rows and of none; the parent's type is another."""
    df = spark.range(20000).repartition(5).selectExpr(
        "(id * 7919) % 20000 div 3 as place", "id as n", "if(id % 97 = 0, null, cast(id * 31 % 12000 as string)) as k",
        "if(id < 40, id div 2, id) as few", "id as none",
    )
    return {"d": df, "p": spark.range(6000).selectExpr("id as k").unionByName(spark.range(50).selectExpr("id as k"))}


@pytest.mark.parametrize("shares, hashes", [(256, 1_000_000), (4, 1_000_000), (4, 10), (1, 1_000_000), (10**9, 10)])
def test_samples_of_value_rules_are_the_first_rows(spark, monkeypatch, shares, hashes):
    """Bounds from some of the keys change nothing, however many keys there are."""
    monkeypatch.setattr(R, "KEY_SHARES", shares)
    monkeypatch.setattr(C, "BROADCAST_HASHES", hashes)
    datasets = _value_rows(spark)
    planned = R.plan([RuleSet("d", 1, VALUE_RULES)], datasets, Clock.at())
    for order in (["place", "n"], ["k", "n"]):
        payloads = {"N": []}
        for r in R.sample(planned, datasets, order_by={"d": order}, max_samples=30).orderBy("rule_id", "position").collect():
            payloads.setdefault(r["rule_id"], []).append(json.loads(r["payload"])["n"])
        for check in planned[0].checks:
            plain = [r["n"] for r in R.violations(check, datasets).orderBy(*order).limit(30).collect()]
            assert payloads[check.rule.rule_id] == plain, (order, check.rule.rule_id)


def test_only_rows_up_to_the_bound_are_joined_with_their_keys(spark):
    datasets = {"d": spark.range(200000).selectExpr("id as place", "id div 4 as k"), "p": spark.range(10).selectExpr("id as k")}
    planned = R.plan([RuleSet("d", 1, VALUE_RULES[:2])], datasets, Clock.at())
    for check in planned[0].checks:
        rows = R._first_violations(check, datasets, ["place"], 20)
        assert 20 <= rows.count() < 50000  # of about 200,000 bad rows


def test_a_sample_that_cannot_be_evaluated_fails_where_it_is_read(spark):
    df = spark.range(50).selectExpr("id as n", "if(id < 49, id div 2, cast(raise_error('no value') as bigint)) as k")
    planned = R.plan([RuleSet("d", 1, VALUE_RULES[:1])], {"d": df}, Clock.at())
    found = R.sample(planned, {"d": df})
    with pytest.raises(Exception, match="no value"):
        found.collect()


def test_one_rule_is_planned_as_top_rows(spark):
    df = spark.range(1000).selectExpr("id as n", "id % 2 as half")
    planned = R.plan([RuleSet("d", 1, (Rule("C", "range", "low", {"column": "half", "min": 1}),))], {"d": df}, Clock.at())
    plan = R.sample(planned, {"d": df})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Generate" not in plan


# --- profiles of row formats ------------------------------------------------

ROWS = """select id as whole, cast(id % 50 as double) / 7 as fraction, cast(id % 9 as decimal(12,3)) / 3 as exact, id % 3 = 0 as flag,
    date_add(date'2024-01-01', cast(id % 6 as int)) as day, timestamp_seconds(id % 8) as moment, cast(id % 5 as string) as digit,
    if(id % 4 = 0, '  ', if(id % 4 = 1, null, concat(repeat('x', 250), id % 2))) as text, cast(null as string) as none,
    cast(if(id % 7 = 0, 'NaN', cast(id % 3 as string)) as float) as holes, named_struct('x', id % 2) as nested, timestamp_ntz'2024-01-01 00:00:01' as still
    from range(2000)"""


def test_one_pass_gives_the_profile_of_row_formats(spark):
    for df in (spark.sql(ROWS), spark.sql(ROWS).limit(0)):
        exact, found = profile({"d": df}), profile({"d": df}, row_formats=["d"])
        assert found.schema.names == exact.schema.names
        for e, f in zip(exact.orderBy("ordinal").collect(), found.orderBy("ordinal").collect(), strict=True):
            for c in exact.columns:
                assert f[c] == (pytest.approx(e[c]) if isinstance(e[c], float) else e[c]), (c, e, f)


def test_a_row_format_is_parsed_once_however_many_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).selectExpr(*[f"id % {i + 2} as c{i}" for i in range(30)]).write.option("header", "true").csv(path)
    df = spark.read.option("header", "true").schema(", ".join(f"c{i} int" for i in range(30))).csv(path)
    plan = profile({"d": df}, row_formats=["d"])._jdf.queryExecution().optimizedPlan().toString()
    assert profile({"d": df})._jdf.queryExecution().optimizedPlan().toString().count("Relation [") > 30
    assert plan.count("Relation [") == 2  # the sums and the frequent values: the same counts, whose shuffle is shared


def test_types_without_a_place_are_profiled_by_column(spark):
    df = spark.sql("select unhex('ab') as b, cast(1 as decimal(38,0)) as wide")
    assert profile({"d": df}, row_formats=["d"]).count() == 2
