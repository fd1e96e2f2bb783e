"""Whole runs: order, containment, samples, sinks, scores, reports."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.model import RESULT_COLUMNS, Rule, RuleSet
from plumbline.operators import report as P
from plumbline.operators.checks import Clock
from plumbline.plans import ruleset_run as R
from plumbline.operators.merging import stamp_version
from plumbline.sources import sinks
from plumbline.sources.registry import rules_table, load_rulesets

AS_OF = datetime(2026, 2, 26)


@pytest.fixture(scope="module")
def datasets(spark):
    rows = [(i, i % 7, "ABC"[i % 3], float(i)) for i in range(400)]
    return {
        "facts": spark.createDataFrame(rows, "id int, k int, c string, x double"),
        "dims": spark.createDataFrame([(i,) for i in range(5)], "k int"),
    }


@pytest.fixture(scope="module")
def rulesets():
    facts = RuleSet(
        "facts",
        2,
        (
            Rule("C001", "completeness", "high", {"column": "c"}),
            Rule("R001", "range", "low", {"column": "x", "min": 0, "max": 99}),
            Rule("D001", "domain", "medium", {"column": "c", "allowed_values": ["A", "B"]}),
            Rule("U001", "uniqueness", "critical", {"column": "k"}),
            Rule("K001", "referential_integrity", "high",
                 {"child_column": "k", "parent_dataset": "dims", "parent_column": "k"}),
            Rule("S001", "schema", "high", {"required_columns": ["zz"]}),
            Rule("U002", "uniqueness", "low", {"column": "k", "max_duplicates_allowed": 1000}),
        ),
    )
    cross = RuleSet("cross", 1, (Rule("K001", "referential_integrity", "critical", {
        "child_dataset": "facts", "child_column": "k", "parent_dataset": "dims", "parent_column": "k"}),))
    return [cross, facts, RuleSet("absent", 1, (Rule("C001", "completeness", "low", {"column": "c"}),))]


def test_results_follow_the_rules(spark, datasets, rulesets):
    rows = R.run_all(spark, "r1", rulesets, datasets, AS_OF).orderBy("seq").collect()
    assert [(r["dataset_id"], r["rule_id"], r["status"]) for r in rows] == [
        ("facts", "C001", "pass"), ("facts", "R001", "fail"), ("facts", "D001", "fail"), ("facts", "U001", "fail"),
        ("facts", "K001", "fail"), ("facts", "S001", "fail"), ("facts", "U002", "pass"), ("cross", "K001", "fail"),
    ]
    assert json.loads(rows[3]["observed_value"])["duplicates"] == 393
    assert rows[0]["ruleset_version"] == 2


def test_nothing_to_run_is_an_error(spark, datasets):
    with pytest.raises(ValueError, match="No results produced"):
        R.run_all(spark, "r", [RuleSet("absent", 1, (Rule("C", "completeness", "low", {"column": "c"}),))], datasets)
    with pytest.raises(ValueError, match="not loaded"):
        R.run_ruleset(spark, "r", RuleSet("absent", 1, ()), datasets)


def test_uncapped_violations_count_what_the_check_counts(spark, datasets, rulesets):
    planned = R.plan([rulesets[1]], datasets, Clock.at(AS_OF))
    measured = {r["seq"]: r for r in R.measure(spark, [rulesets[1]], datasets, AS_OF).collect()}
    for check in planned[0].checks:
        if check.rule.rule_type in ("range", "domain", "referential_integrity", "completeness"):
            rows = R.violations(check, datasets).count()
            assert rows == measured[check.seq]["failed"]
            good = datasets["facts"].count() - rows
            assert rows + good == measured[check.seq]["total"]


def test_execute_writes_results_and_samples(spark, datasets, rulesets, tmp_path):
    base = str(tmp_path / "out")
    run = R.execute(spark, "007", rulesets, datasets, base, AS_OF, order_by={"facts": ["id"]}, max_samples=5)
    table = sinks.read_results(spark, base, "007")
    assert tuple(table.columns) == (*RESULT_COLUMNS, "seq")
    rows = table.orderBy("seq").collect()
    assert [r["status"] for r in rows].count("fail") == 6
    assert all(r["started_at"] <= r["finished_at"] and r["execution_ms"] >= 0 for r in rows)
    refs = {(r["dataset_id"], r["rule_id"]): r["sample_ref"] for r in rows}
    assert refs["facts", "C001"] is None and refs["facts", "S001"] is None
    assert refs["facts", "R001"].endswith("bad_samples/run_id=007/generation=1/dataset_id=facts/rule_id=R001")
    samples = sinks.read_samples(spark, base).where("dataset_id = 'facts' and rule_id = 'R001'")
    payloads = [json.loads(r["payload"]) for r in samples.orderBy("position").collect()]
    assert [p["id"] for p in payloads] == [100, 101, 102, 103, 104]
    counts = {(r["dataset_id"], r["rule_id"]): r["count"] for r in run.samples.groupBy("dataset_id", "rule_id").count().collect()}
    assert set(counts.values()) == {5} and ("cross", "K001") in counts
    assert len(spark.read.parquet(refs["facts", "R001"]).collect()) == 5


def test_a_run_id_that_is_there_is_replaced(spark, datasets, rulesets, tmp_path):
    base, run_id = str(tmp_path / "out"), "a/b=c:1%"
    counts = []
    for _ in range(2):
        R.execute(spark, run_id, rulesets, datasets, base, AS_OF, max_samples=3)
        R.execute(spark, "other", rulesets, datasets, base, AS_OF, max_samples=2)
        rows = sinks.read_results(spark, base, run_id).collect()
        counts.append((len(rows), sinks.read_samples(spark, base).where(F.col("run_id") == run_id).count()))
    assert counts[0] == counts[1] and counts[0][0] == 8
    for ref in [r["sample_ref"] for r in rows if r["sample_ref"]]:
        assert spark.read.parquet(ref).count() == 3


def test_a_run_that_dies_leaves_the_old_one(spark, datasets, rulesets, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    R.execute(spark, "r", rulesets, datasets, base, AS_OF, max_samples=3)

    def state():
        results = sinks.read_results(spark, base, "r").orderBy("seq").collect()
        return results, sinks.read_samples(spark, base, "r").orderBy("dataset_id", "rule_id", "position").collect()

    before = state()

    def die(*args):
        raise RuntimeError("driver lost")

    for step in ("append_samples", "append_results"):
        with monkeypatch.context() as patch:
            patch.setattr(R, step, die)
            with pytest.raises(RuntimeError):
                R.execute(spark, "r", rulesets, datasets, base, AS_OF, max_samples=1)
        assert state() == before
    earlier = sinks.read_results(spark, base)  # a frame made before a commit keeps its files
    R.execute(spark, "r", rulesets, datasets, base, AS_OF, max_samples=1)
    assert len(state()[1]) < len(before[1]) and len(state()[0]) == earlier.count() == 8
    assert sinks.vacuum_runs(spark, base) == 3  # two finished folders, and what a dead run left
    assert len(state()[0]) == 8 and sinks.vacuum_runs(spark, base) == 0


def test_of_two_writers_of_a_run_the_later_beginner_counts(spark, tmp_path):
    base = str(tmp_path / "out")
    first, second = sinks.begin_run(spark, base, "r"), sinks.begin_run(spark, base, "r")
    assert (first.number, second.number) == (1, 2)
    rows = spark.createDataFrame([("r", "d", "one"), ("r", "d", "two")], "run_id string, dataset_id string, rule_id string")
    sinks.append_results(rows.where("rule_id = 'two'"), second)
    second.commit()
    sinks.append_results(rows.where("rule_id = 'one'"), first)
    first.commit()
    assert [r["rule_id"] for r in sinks.read_results(spark, base).collect()] == ["two"]
    assert sinks.read_results(spark, base, "absent").count() == sinks.read_samples(spark, str(tmp_path / "none")).count() == 0


def test_two_writers_of_a_registry_get_two_versions(spark, rulesets, tmp_path):
    base = str(tmp_path / "registry")
    sinks.append_rules(rules_table(spark, rulesets), base)
    held = sinks.read_rules(spark, base)
    made = [stamp_version(rules_table(spark, rulesets), held) for _ in range(2)]  # both before either is written
    versions = [{(r["dataset_id"], r["ruleset_version"]) for r in sinks.publish_rules(m, base).collect()} for m in made]
    assert not versions[0] & versions[1] and {d for d, _ in versions[0]} == {d for d, _ in versions[1]}
    stored = sinks.read_rules(spark, base).groupBy("dataset_id", "ruleset_version", "rule_id").count()
    assert stored.where("count > 1").count() == 0


def test_other_faults_end_a_run(spark, datasets, rulesets, monkeypatch):
    def lost(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(R, "_measure", lost)
    with pytest.raises(RuntimeError):
        R.execute(spark, "r", rulesets, datasets, None, AS_OF)


def test_what_is_not_run_is_said(spark, datasets):
    orphan = RuleSet("absent", 1, (Rule("C", "completeness", "critical", {"column": "x"}),))
    facts = RuleSet("facts", 1, (Rule("C", "completeness", "low", {"column": "x"}),))
    with pytest.warns(UserWarning) as said:
        assert R.select_rulesets([orphan, facts], datasets) == [facts]
    assert any("absent" in str(w.message) for w in said)


def test_sample_has_the_first_ten_columns(spark):
    df = spark.createDataFrame([tuple(range(12))], ", ".join(f"c{i} int" for i in range(12)))
    rule = RuleSet("wide", 1, (Rule("R", "range", "low", {"column": "c11", "max": 0}),))
    planned = R.plan([rule], {"wide": df}, Clock.at(AS_OF))
    row = R.sample(planned, {"wide": df}).first()
    assert list(json.loads(row["payload"])) == [f"c{i}" for i in range(10)]


def test_a_failing_plan_is_retried_rule_by_rule(spark, tmp_path):
    good = spark.range(10).selectExpr("id", "cast(id as string) as s")
    broken = good.selectExpr("id", "cast(if(id = 3, 'boom', s) as int) as n")  # fails when read
    rules = RuleSet("d", 1, (
        Rule("C001", "completeness", "high", {"column": "id"}),
        Rule("C002", "completeness", "high", {"column": "n"}),
    ))
    rows = R.execute(spark, "r", [rules], {"d": broken}, None, AS_OF).results.orderBy("seq").collect()
    assert [r["status"] for r in rows] == ["pass", "fail"]
    observed = json.loads(rows[1]["observed_value"])
    assert observed["error"] == "CAST_INVALID_INPUT" and "boom" in observed["message"]
    assert json.loads(rows[1]["threshold"]) == {"column": "n"}


def test_many_rules_take_several_scans(spark, datasets, monkeypatch):
    monkeypatch.setattr(R, "CHECKS_PER_SCAN", 3)
    rules = tuple(Rule(f"R{i}", "range", "low", {"column": "x", "min": i}) for i in range(8))
    rows = R.measure(spark, [RuleSet("facts", 1, rules)], datasets, AS_OF).orderBy("seq").collect()
    assert [r["failed"] for r in rows] == list(range(8))


def test_many_rule_sets_take_several_jobs(spark, datasets, rulesets, monkeypatch):
    monkeypatch.setattr(R, "RULES_PER_JOB", 4)
    jobs = R._jobs(R.plan(R.select_rulesets(rulesets, datasets), datasets, Clock.at(AS_OF)))
    assert [[len(p.checks) for p in job] for job in jobs] == [[4], [3, 1]]
    rows = R.execute(spark, "r", rulesets, datasets, None, AS_OF).results.orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(8))


def _results(spark, rows):
    layout = ("run_id string, dataset_id string, rule_id string, rule_type string, severity string, status string,"
              "observed_value string, sample_ref string, seq int")
    full = [(run, d, f"R{i}", "range", sev, st, "{}", None, i) for i, (run, d, sev, st) in enumerate(rows)]
    return spark.createDataFrame(full, layout)


def test_scores_and_status(spark):
    results = _results(spark, [("a", "x", "low", "pass"), ("a", "x", "high", "fail"), ("a", "y", "low", "pass"),
                               ("b", "x", "critical", "fail"), ("c", "x", "critical", "pass")])
    rows = {r["run_id"]: (r["status"], r["score"], r["total_rules"], r["failed"], r["failed_critical"])
            for r in P.run_summary(results).collect()}
    assert rows == {"a": ("warn", 66.67, 3, 1, 0), "b": ("fail", 0.0, 1, 1, 1), "c": ("pass", 100.0, 1, 0, 0)}
    empty = P.run_summary(results, "none").first()
    assert (empty["status"], empty["score"], empty["total_rules"]) == ("pass", 100.0, 0)
    assert P.latest_run(results).select("run_id").distinct().first()[0] == "c"


def test_score_rounds_half_to_even(spark):
    results = _results(spark, [("a", "x", "low", "fail")] * 3 + [("a", "x", "low", "pass")] * 797)
    assert P.run_summary(results).first()["score"] == round(100 - 100 * 3 / 800, 2)


def test_kpi_digest_and_actions(spark):
    rows = [("a", f"d{i % 2}", ("high", "medium")[i % 2], "fail") for i in range(30)] + [("a", "d2", "low", "pass")]
    results = _results(spark, rows)
    assert [tuple(r) for r in P.kpi(results).collect()] == [
        ("d0", "high", "fail", 15), ("d1", "medium", "fail", 15), ("d2", "low", "pass", 1),
    ]
    digest = P.digest(results).first()
    assert digest["headline"] == "[DQ] Local run result: WARN | datasets=3 | failed_rules=30"
    assert [f["rule_id"] for f in digest["top_failures"]] == [f"R{i}" for i in range(20)]
    assert P.top_failures(results).count() == 30
    todo = P.run_actions(results).first()
    assert (todo["stop_pipeline"], todo["create_ado_task"], todo["notify_channels"]) == (False, False, ["email", "teams"])
    assert P.digest(results.where(F.col("status") == "pass")).first()["top_failures"] == []


def test_rules_round_trip(spark, rulesets, tmp_path):
    base = str(tmp_path / "registry")
    sinks.append_rules(rules_table(spark, rulesets), base)
    found = load_rulesets(sinks.read_rules(spark, base), ["facts", "cross"])
    assert set(found) == {"facts", "cross"}
    assert found["facts"].rules == rulesets[1].rules
