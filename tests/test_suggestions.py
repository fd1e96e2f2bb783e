"""Profile, key detection, candidates, proposals, guardrails, merging, validation."""

from __future__ import annotations

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.model import RULES_SCHEMA, Rule, RuleSet
from plumbline.operators import candidates as B
from plumbline.operators import guardrails as G
from plumbline.operators import key_detection as K
from plumbline.operators import merging as M
from plumbline.operators import numbering as N
from plumbline.operators import proposals as H
from plumbline.operators.profile import columnar, profile, profile_in_batches
from plumbline.plans.suggestion import suggest
from plumbline.sources.registry import current_rules, rules_table

ALL_TYPES = G.RULE_TYPES


def columns_of(df):
    return {r["column"]: r for r in profile({"d": df}).collect()}


# --- profile ----------------------------------------------------------------


def test_profile_of_an_empty_column_and_of_nulls(spark):
    readings = [2.5, 2.5, 2.5, 8.0, 8.0, -3.5, None, None, None]
    found = columns_of(spark.createDataFrame([(x, None) for x in readings], "reading double, remark string"))
    k, e = found["reading"], found["remark"]
    assert (k["non_null_count"], k["distinct_count"], k["distinct_ratio_non_null"]) == (6, 3, 0.5)
    assert (k["min"], k["max"], k["mean"], k["max_dup_count"], k["duplicate_count"]) == (-3.5, 8.0, 20 / 6, 3, 3)
    assert (e["non_null_count"], e["distinct_count"], e["distinct_ratio_non_null"], e["max_dup_count"]) == (0, 0, 0.0, 0)
    assert e["top_values"] == [] and e["min"] is None


def test_profile_blanks_count_as_nulls_and_as_values(spark):
    s = columns_of(spark.createDataFrame([(" ",), ("\t",), ("a",), (None,)], "s string"))["s"]
    assert (s["null_count"], s["null_pct"], s["distinct_count"], s["non_null_count"]) == (3, 0.75, 3, 1)
    assert (s["distinct_ratio_non_null"], s["duplicate_count"]) == (3.0, 0)


def test_profile_types(spark):
    layout = "b boolean, i int, l bigint, f float, x double, m decimal(10,2), d date, t timestamp, n timestamp_ntz, a array<int>, o map<string,int>"
    df = spark.createDataFrame([(True, 1, 2, 0.5, float("nan"), None, date(2026, 1, 1), None, None, [1, 2], {"a": 1})] * 2, layout)
    found = columns_of(df)
    assert [found[c]["dtype"] for c in df.columns] == [
        "bool", "int32", "int64", "float32", "float64", "number(10,2)", "datetime64[ns]", "datetime64[ns]",
        "datetime64[ns]", "object", "object",
    ]
    assert (found["b"]["mean"], found["b"]["max"]) == (1.0, 1.0)
    assert (found["x"]["null_count"], found["x"]["distinct_count"], found["x"]["mean"]) == (2, 0, None)
    assert [(v["value"], v["count"]) for v in found["a"]["top_values"]] == [("[1,2]", 2)]
    assert [(v["value"], v["count"]) for v in found["o"]["top_values"]] == [('{"a":1}', 2)]


def test_profiles_of_many_columns_are_lazy(spark):
    wide = spark.createDataFrame([tuple(range(65))], ", ".join(f"c{i} int" for i in range(65)))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "planning only")
    try:
        planned = profile({"wide": wide})
        assert len(tracker.getJobIdsForGroup("lazy")) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert planned.schema["ordinal"] is not None


def test_a_csv_is_parsed_once_for_all_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(50).selectExpr("id", "id % 3 as k", "'x' as s").write.option("header", "true").csv(path)
    df = spark.read.option("header", "true").schema("id bigint, k bigint, s string").csv(path)
    rewritten = profile({"d": columnar(df)})
    order = ["ordinal"]
    assert rewritten.orderBy(*order).collect() == profile({"d": df}).orderBy(*order).collect()
    assert "csv" not in rewritten._jdf.queryExecution().optimizedPlan().toString().lower()


def test_profile_in_batches_of_columns(spark):
    wide = spark.createDataFrame([(i, "x", i % 2, None) for i in range(6)], "a int, b string, c int, d string")
    other = spark.createDataFrame([(1, 2)], "`e{f}` int, `it's ``g``.h` int")
    whole = profile({"wide": wide, "other": other})
    batched = profile_in_batches({"wide": wide, "other": other}, 3)
    order = ["dataset_id", "ordinal"]
    rows = whole.orderBy(*order).collect()
    assert rows == batched.orderBy(*order).collect()
    assert [r["column"] for r in rows] == ["e{f}", "it's `g`.h", "a", "b", "c", "d"]


def test_profile_of_no_rows(spark):
    found = columns_of(spark.createDataFrame([], "i int, s string"))
    assert [(r["row_count"], r["null_pct"], r["top_values"], r["max"]) for r in found.values()] == [(0, 0.0, [], None)] * 2


def test_profile_top_values_are_whole_and_typed(spark):
    long = "z" * 30_000
    values = columns_of(spark.createDataFrame([(i % 12, long if i % 2 else "s") for i in range(120)], "n int, t string"))
    assert [v["value"] for v in values["n"]["top_values"]] == [str(i) for i in range(10)]
    assert [(v["value"], v["count"]) for v in values["t"]["top_values"]] == [("s", 60), (long, 60)]


# --- key detection ----------------------------------------------------------


def keys_of(df, policy=K.STANDARD_POLICY):
    return K.key_candidates(profile({"d": df}), policy).orderBy("rank").collect()


def test_key_candidate_and_its_rules(spark):
    df = spark.createDataFrame([(7000 + 3 * i, ["open", "shut", "lost"][i % 3]) for i in range(42)], "ticket_id int, state string")
    (key,) = keys_of(df)
    assert key["columns"] == ["ticket_id"] and key["confidence"] == 1.0 and key["notes"] == []
    assert key["evidence"]["name_signals"]["positive"] == ["(^|_)id$"]
    assert key["evidence"]["distinct_count"] == 42
    rules = K.key_rules(K.key_candidates(profile({"d": df}))).orderBy("ordinal").collect()
    assert [(r["rule_type"], r["column"], r["severity"]) for r in rules] == [
        ("uniqueness", "ticket_id", "high"), ("completeness", "ticket_id", "high"),
    ]


def test_key_candidates_are_capped_in_column_order(spark):
    df = spark.createDataFrame([(i, -i, 5 * i, i + 9) for i in range(33)], "east_id int, north_id int, south_id int, west_id int")
    policy = K.KeyPolicy.of({"suggestions": {"key_detection": {"max_candidates": 3}}})
    assert [k["columns"][0] for k in keys_of(df, policy)] == ["east_id", "north_id", "south_id"]


def test_nulls_and_missing_policy_give_no_keys(spark):
    gaps = spark.createDataFrame([(f"k{i}" if i % 3 else None,) for i in range(90)], "order_id string")
    assert keys_of(gaps) == []
    assert keys_of(spark.createDataFrame([(i * i,) for i in range(14)], "order_id int"), K.KeyPolicy.of({})) == []


def test_near_unique_key(spark):
    df = spark.createDataFrame([(f"c{i}",) for i in [*range(246), 17, 18, 19, 20]], "batch_id string")
    (key,) = keys_of(df)
    assert key["notes"] == ["near-unique (within near-unique thresholds)", "max_dup_count=2"]
    # 0.4 near + 0.2 * (246/250 - 0.85) / 0.15 + 0.1 no nulls + 0.1 name
    assert key["confidence"] == pytest.approx(0.4 + 0.2 * (246 / 250 - 0.85) / 0.15 + 0.1 + 0.1)


def test_key_confidence_of_200_values_in_202_rows(spark):
    df = spark.createDataFrame([(f"M{min(i, 199):05d}" if i < 201 else "M00000",) for i in range(202)], "material_id string")
    assert keys_of(df)[0]["confidence"] == pytest.approx(0.7867986798679868, abs=1e-12)


# --- candidates and proposals -----------------------------------------------


def candidates(df, kind, **limits):
    found = B.column_candidates(profile({"d": df}), (kind,), B.CandidateLimits(**limits))
    return [r["column"] for r in found.orderBy("rank").collect()]


def test_candidates_by_rule_type(spark):
    rows = [(1.25, "north", 40, True), (-7.5, "south", 41, True), (0.0, "east", 42, False), (3.0, "west", 43, False)]
    df = spark.createDataFrame(rows, "height double, side string, floor int, lit boolean")
    assert candidates(df, "range") == ["height", "floor"]
    assert candidates(df, "domain", domain_threshold=3) == ["lit"]
    assert candidates(df, "domain") == ["lit", "height", "side", "floor"]
    assert candidates(df, "completeness") == ["height", "side", "floor", "lit"]
    assert candidates(df, "uniqueness", uniqueness_threshold=0.8) == ["height", "side", "floor"]


def test_candidate_caps_and_date_names(spark):
    wide = spark.createDataFrame([tuple(range(30))], ", ".join(f"col_{i} int" for i in range(30)))
    assert len(candidates(wide, "range", max_range=10)) == 10
    dates = spark.createDataFrame([("2026-01-01", "x", 1, 2, date(2026, 1, 1), "y")],
                                  "created_at string, event_dt string, amount int, width int, day date, EndTime string")
    assert candidates(dates, "date_not_in_future") == ["created_at", "event_dt", "width", "day", "EndTime"]
    assert B.column_candidates(profile({"d": dates}), ()).count() == 0


def test_heuristic_proposals(spark):
    rows = [(("RECEIPT", "ISSUE", "MOVE")[i % 3], "2/26/2026", -5.0 + i, f"id{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "kind string, ts_load string, quantity double, code string")
    found = H.propose_rules(profile({"d": df})).orderBy("ordinal").collect()
    assert [(r["rule_type"], r["column"], r["severity"], r["confidence"]) for r in found] == [
        ("domain", "ts_load", "medium", "0.7"), ("domain", "kind", "medium", "0.7"),
        ("date_not_in_future", "ts_load", "medium", "0.6"), ("range", "quantity", "low", "0.6"),
    ]
    assert json.loads(found[1]["params"]) == {"allowed_values": ["ISSUE", "MOVE", "RECEIPT"]}
    assert found[3]["rationale"] == "Observed min=-5.0; suggest non-negative constraint."
    assert json.loads(found[3]["evidence_used"]) == ["min=-5.0", "max=54.0"]
    capped = H.propose_rules(profile({"d": df}), max_rules_to_add=2)
    assert [r["column"] for r in capped.orderBy("ordinal").collect()] == ["ts_load", "kind"]


def test_a_domain_is_proposed_only_if_all_values_are_listed(spark):
    some = spark.createDataFrame([(f"v{i % 12}",) for i in range(50)], "kind string")
    (found,) = H.propose_rules(profile({"d": some}, H.MAX_LISTED_VALUES)).collect()
    assert sorted(json.loads(found["params"])["allowed_values"]) == sorted(f"v{i}" for i in range(12))
    df = spark.createDataFrame([(f"v{i % 11}",) for i in range(50)], "kind string")
    assert H.propose_rules(profile({"d": df})).count() == 0


# --- guardrails -------------------------------------------------------------


def judge(spark, proposals, columns=("a", "b", "id"), existing=(), **options):
    raw = spark.createDataFrame([("d", i, json.dumps(p)) for i, p in enumerate(proposals)],
                                "dataset_id string, ordinal bigint, raw string")
    known = spark.createDataFrame([("d", c) for c in columns], "dataset_id string, column string")
    rules = rules_table(spark, [RuleSet("d", 1, tuple(existing))]) if existing else spark.createDataFrame([], RULES_SCHEMA)
    return G.judge_proposals(H.parse_proposals(raw), known, rules, **options)


def reasons(decided):
    return {r["ordinal"]: r["reject_reason"] for r in decided.collect()}


def test_each_reason_to_reject(spark):
    cases = [
        ({"type": "completeness", "columns": ["b"], "params": {"max_null_percent": 12}}, None),
        ({"rule_type": "uniqueness", "column": "id", "confidence": 0.97}, None),
        ({"rule_type": "uniqueness", "columns": ["a", "b"]}, G.SEVERAL_COLUMNS),
        ([1], G.NOT_A_DICT),
        ("text", G.NOT_A_DICT),
        ({"rule_type": "weird"}, "type not allowed: weird"),
        ({"column": "a"}, "type not allowed: None"),
        ({"rule_type": "completeness"}, G.NO_COLUMN),
        ({"rule_type": "completeness", "column": "  "}, G.NO_COLUMN),
        ({"rule_type": "completeness", "column": "A"}, "column not in dataset: A"),
        ({"rule_type": "range", "column": "a", "params": [1]}, G.PARAMS_NOT_DICT),
        ({"rule_type": "range", "column": "a", "params": []}, G.RANGE_PARAMS),
        ({"rule_type": "range", "column": "a", "params": {"min": None}}, None),
        ({"rule_type": "domain", "column": "a", "params": {}}, G.DOMAIN_PARAMS),
        ({"rule_type": "domain", "column": "a", "expectation": {"allowed_values": [1]}}, G.DOMAIN_PARAMS),
        ({"rule_type": "domain", "column": "a", "params": {"max_distinct": 5}}, None),
        ({"rule_type": "freshness", "params": {"ts_column": "x", "max_age_days": 3}}, None),
        ({"rule_type": "completeness", "columns": ["b", " "], "expectation": {"max_null_percent": 12}}, G.DUPLICATE),
    ]
    decided = judge(spark, [c for c, _ in cases], max_rules_to_add=100)
    assert reasons(decided) == {i: reason for i, (_, reason) in enumerate(cases)}
    assert decided.where("ordinal = 1").first()["column"] == "id"


def test_confidence_threshold(spark):
    cases = [0.9, 0.5, "0.7", "high", None]
    proposals = [{"rule_type": "range", "column": "a", "params": {"min": i}, "confidence": c} for i, c in enumerate(cases)]
    assert reasons(judge(spark, proposals, min_confidence=0.6)) == {
        0: None, 1: "confidence below threshold: 0.5", 2: None, 3: "confidence below threshold: high",
        4: "confidence below threshold: None",
    }


def test_signatures_ignore_order_and_spelling_of_numbers(spark):
    proposals = [
        {"rule_type": "domain", "column": "a", "params": {"allowed_values": ["x", "y"]}},
        {"rule_type": "domain", "columns": ["a"], "params": {"allowed_values": ["y", "x"]}, "severity": "low"},
        {"rule_type": "range", "column": "b", "params": {"max": 5, "min": 0}},
        {"rule_type": "range", "column": "b", "params": {"min": 0.0, "max": 5.0}},
        {"rule_type": "range", "column": "b", "params": {"min": "0", "max": 5}},
        {"rule_type": "uniqueness", "column": "id"},
    ]
    existing = [Rule("U1", "uniqueness", "low", {"column": "id"})]
    assert [r is None for _, r in sorted(reasons(judge(spark, proposals, existing=existing)).items())] == [
        True, False, True, False, True, False,
    ]


@pytest.mark.parametrize("cap", [0, 1, 3, 7, 100])
def test_first_wins_and_cap_agree_with_a_loop(spark, cap):
    rng = random.Random(cap)
    proposals = [{"rule_type": "range", "column": rng.choice("abz"), "params": {"min": rng.randrange(5)}} for _ in range(60)]
    accepted, rejected, seen = set(), set(), {("b", 0)}
    for i, p in enumerate(proposals):
        key = (p["column"], p["params"]["min"])
        if p["column"] == "z" or key in seen:
            rejected.add(i)
            continue
        accepted.add(i)
        seen.add(key)
        if len(accepted) >= cap:
            break
    existing = [Rule("R1", "range", "low", {"column": "b", "min": 0})]
    decided = judge(spark, proposals, existing=existing, max_rules_to_add=cap).collect()
    assert {r["ordinal"] for r in decided if r["decision"] == "accepted"} == accepted
    assert {r["ordinal"] for r in decided if r["decision"] == "rejected"} == rejected


# --- merging ----------------------------------------------------------------


def merge(spark, existing, proposals, **options):
    raw = spark.createDataFrame([("d", i, json.dumps(p)) for i, p in enumerate(proposals)],
                                "dataset_id string, ordinal bigint, raw string")
    rules = rules_table(spark, [RuleSet("d", 1, tuple(existing))])
    return M.merge_rules(rules, H.parse_proposals(raw), "ai_patcher", **options).orderBy("ordinal").collect()


def test_merge_shapes_and_metadata(spark):
    rows = merge(spark, [], [
        {"type": "uniqueness", "columns": ["parcel_no"], "severity": "low", "params": {"max_duplicates_allowed": 3},
         "confidence": 0.71, "rationale": "three parcels were relabelled", "evidence_used": ["row_count=812", "duplicate_count=3"],
         "description": "one label per parcel"},
        {"column": "skipped"},
        {"rule_type": "range", "column": "x", "params": {"column": "y", "min": 1}},
        {"rule_type": "completeness", "expectation": {"column": "z", "max_null_percent": 5}, "column": "other"},
        {"rule_type": "odd"},
    ])
    assert [(r["rule_id"], r["rule_type"], r["severity"], json.loads(r["expectation"])) for r in rows] == [
        ("U001", "uniqueness", "low", {"column": "parcel_no", "max_duplicates_allowed": 3}),
        ("R001", "range", "medium", {"column": "y", "min": 1}),
        ("C001", "completeness", "medium", {"column": "z", "max_null_percent": 5}),
        ("R002", "odd", "medium", {}),
    ]
    first = rows[0]
    assert (first["ai_confidence"], first["ai_rationale"], first["suggested_by"], first["description"]) == (
        0.71, "three parcels were relabelled", "ai_patcher", "one label per parcel",
    )
    assert json.loads(first["ai_evidence_used"]) == ["row_count=812", "duplicate_count=3"]


def test_ids_fill_gaps_and_reserve_explicit_ones(spark):
    existing = [Rule(i, "completeness", "low", {"column": i}) for i in ("C001", "C003", "C0004", "C1000", "schema_0001")]
    new = [{"rule_type": "completeness", "column": c} for c in "abc"]
    new.insert(1, {"rule_type": "completeness", "column": "own", "rule_id": "C002"})
    rows = merge(spark, existing, new)[5:]
    assert [r["rule_id"] for r in rows] == ["C004", "C002", "C005", "C006"]
    assert [r["ordinal"] for r in rows] == [6, 7, 8, 9]


def test_ids_agree_with_a_loop_for_groups_of_many_slices(spark, monkeypatch):
    monkeypatch.setattr(N, "SLICE", 4)
    rng = random.Random(5)
    used = sorted(rng.sample(range(1, 60), 25))
    existing = [Rule(f"U{n:03d}", "uniqueness", "low", {"column": f"c{n}"}) for n in used]
    rows = merge(spark, existing, [{"rule_type": "uniqueness", "column": f"n{i}"} for i in range(40)])[25:]
    free = [n for n in range(1, 200) if n not in used]
    assert [r["rule_id"] for r in rows] == [f"U{n:03d}" for n in free[:40]]


def test_numbering_within_skewed_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "SLICE", 10)
    rows = [("hot", i * 3) for i in range(300)] + [("b", 7), ("c", 5), ("c", 1)]
    df = spark.createDataFrame(rows, "g string, o bigint")
    got = {(r["g"], r["o"]): r["k"] for r in N.number_within(df, ["g"], "o", "k").collect()}
    expected = {}
    for g in ("hot", "b", "c"):
        expected.update({(g, o): k for k, o in enumerate(sorted(o for h, o in rows if h == g), start=1)})
    assert got == expected


def test_versions(spark):
    rules = rules_table(spark, [RuleSet("d", 4, (Rule("C001", "completeness", "low", {"column": "a"}),))])
    raw = spark.createDataFrame([(d, 1, '{"rule_type": "completeness", "column": "b"}') for d in ("d", "new")],
                                "dataset_id string, ordinal bigint, raw string")
    merged = M.stamp_version(M.merge_rules(rules, H.parse_proposals(raw), "x"), rules)
    assert {(r["dataset_id"], r["ruleset_version"], r["status"]) for r in merged.collect()} == {
        ("d", 5, "suggested"), ("new", 1, "suggested"),
    }


def test_current_rules_are_the_highest_active_version(spark):
    def table(version, status):
        return rules_table(spark, [RuleSet("d", version, (Rule("C001", "completeness", "low", {}),))], status)

    rules = table(1, "active").unionByName(table(2, "active")).unionByName(table(3, "suggested"))
    assert [r["ruleset_version"] for r in current_rules(rules).collect()] == [2]


@pytest.mark.parametrize(
    ("rule", "problem"),
    [
        (Rule("a", "uniqueness", "high", {"column": "id", "max_duplicates_allowed": 0}), None),
        (Rule("a", None, "high", {"column": "id"}), "rule_type is required"),
        (Rule("a", "unknown", "high", {"column": "id"}), "unknown rule type: unknown"),
        (Rule("a", "domain", "high", {"column": "id"}), "allowed_values is required"),
        (Rule("a", "domain", "high", {"column": "id", "allowed_values": []}), "allowed_values is required"),
        (Rule("a", "domain", "high", {"column": "id", "max_distinct": 3}), "allowed_values is required"),
        (Rule("a", "range", "high", {"column": "id"}), "range must have min and/or max"),
        (Rule("a", "range", "high", {"column": 5, "min": 1}), "column is required"),
        (Rule("a", "schema", "high", {"required_columns": []}), "required_columns is required"),
        (Rule("a", "freshness", "high", {}), None),
        (Rule("a", "completeness", None, {"column": "x"}), "severity is required"),
        (Rule("a", "completeness", "low", [1]), "expectation must be an object"),
    ],
)
def test_validation(spark, rule, problem):
    found = M.validate_rules(rules_table(spark, [RuleSet("d", 1, (rule,))])).collect()
    assert [r["problem"] for r in found] == ([problem] if problem else [])


# --- the whole way ----------------------------------------------------------


def test_suggest_twice_adds_nothing_new(spark):
    rows = [(f"M{i:03d}", "kg" if i % 2 else "g", -1.0 + i, "2026-02-01") for i in range(60)]
    datasets = {"items": spark.createDataFrame(rows, "item_id string, unit string, weight double, ts_load string")}
    catalog = [{"dataset_id": "items", "source_type": "csv", "source_location": "x", "owner_team": "T",
                "ts_load_column": "ts_load", "freshness_max_age_days": 2}]
    first = suggest(spark, catalog, datasets, spark.createDataFrame([], RULES_SCHEMA))
    rules = first.rules.orderBy("ordinal").collect()
    assert [r["rule_id"] for r in rules] == [
        "schema_0001", "freshness_0001", "U001", "C001", "U002", "C002", "D001", "D002", "T001", "R001",
    ]
    assert {r["owner_team"] for r in rules} == {"T"} and {r["data_owner"] for r in rules} == {"UNKNOWN"}
    assert M.validate_rules(first.rules).count() == 0
    again = suggest(spark, catalog, datasets, first.rules.withColumn("status", F.lit("active")))
    summary = again.summary.first()
    assert (summary["ruleset_version"], summary["rules"], summary["accepted"], summary["rejected"]) == (2, 10, 0, 4)


def test_outside_proposals_replace_the_heuristics(spark):
    datasets = {"d": spark.createDataFrame([(i % 3,) for i in range(9)], "a int")}
    raw = spark.createDataFrame([("d", 1, '{"rule_type":"range","column":"a","params":{"min":0},"confidence":0.2}'),
                                 ("d", 2, '{"rule_type":"range","column":"a","params":{"min":0},"confidence":0.8}')],
                                "dataset_id string, ordinal bigint, raw string")
    made = suggest(spark, [{"dataset_id": "d"}], datasets, spark.createDataFrame([], RULES_SCHEMA),
                   proposals=H.parse_proposals(raw), min_confidence=0.5)
    assert [(r["rule_id"], r["ai_confidence"]) for r in made.rules.collect()] == [("R001", 0.8)]
    assert made.summary.first()["rejected"] == 1
