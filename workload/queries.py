"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.model import RULES_SCHEMA, Rule, RuleSet
from plumbline.operators import candidates as B
from plumbline.operators import guardrails as G
from plumbline.operators import key_detection as K
from plumbline.operators import merging as M
from plumbline.operators import proposals as H
from plumbline.operators import report as P
from plumbline.operators import sketches as S
from plumbline.operators.checks import Clock
from plumbline.operators.profile import profile
from plumbline.operators.value_counts import union_all
from plumbline.plans import ruleset_run as R
from plumbline.plans.suggestion import suggest
from plumbline.session import settle, shared_folder
from plumbline.sources import sinks
from plumbline.sources.catalog import load_by_id, load_datasets, row_formats
from plumbline.sources.registry import current_rules, load_rulesets, rules_table
from workload import data as D

Query = Callable[[SparkSession, str], DataFrame]

VERDICT = ("rule_id", "status", "failed", "total")


def _measured(
    spark: SparkSession, datasets: dict[str, DataFrame], *rules: Rule, as_of: datetime = D.AS_OF
) -> DataFrame:
    """Measures of some rules on the first of the datasets."""
    ruleset = RuleSet(next(iter(datasets)), 1, rules)
    return R.measure(spark, [ruleset], datasets, as_of)


def _top(measured: DataFrame) -> DataFrame:
    """The frequent values of each rule as rows next to its verdict."""
    return measured.select(*VERDICT, F.posexplode_outer("top").alias("at", "e")).select(
        *VERDICT,
        (F.col("at") + 1).cast("bigint").alias("place"),
        F.col("e.value").alias("value"),
        F.col("e.n").alias("n"),
    )


# --- checks -----------------------------------------------------------------


def check_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Required columns of three tables, next to how many rows that concerns."""
    wanted = {
        "orders": ["o_orderkey", "o_orderdate", "ts_load"],
        "lineitem": ["l_orderkey", "L_LINENUMBER", "l_shipdate"],
        "documents": ["doc_id", "text"],
    }
    datasets = {name: D.table(spark, folder, name) for name in wanted}
    rulesets = [
        RuleSet(name, 1, (Rule("G001", "schema", "high", {"required_columns": columns}),))
        for name, columns in wanted.items()
    ]
    verdicts = R.measure(spark, rulesets, datasets, D.AS_OF)
    missing = F.from_json(F.get_json_object("observed_value", "$.missing_columns"), "array<string>")
    sizes = R.C.union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset_id", F.lit(name))
            for name, df in datasets.items()
        ]
    )
    return verdicts.join(sizes, "dataset_id").select(
        "dataset_id", "status", F.array_join(missing, ",").alias("missing_columns"), "rows"
    )


def check_completeness(spark: SparkSession, folder: str) -> DataFrame:
    measured = _measured(
        spark,
        {"orders": D.orders(spark, folder)},
        Rule("C001", "completeness", "high", {"column": "o_orderpriority"}),
        Rule("C002", "completeness", "high", {"column": "o_orderpriority", "max_null_percent": 50}),
        Rule("C003", "completeness", "high", {"column": "o_totalprice"}),
    )
    return measured.select(*VERDICT, F.round("null_pct", 6).alias("null_pct"))


def check_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return _top(
        _measured(
            spark,
            {"lineitem": D.table(spark, folder, "lineitem")},
            Rule("U001", "uniqueness", "high", {"column": "l_orderkey"}),
            Rule("U002", "uniqueness", "low", {"column": "l_extendedprice", "max_duplicates_allowed": 10**9}),
        )
    )


def check_uniqueness_suspects(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of ``check_uniqueness`` and a long text, counted by hash first; only repeated hashes are counted by key."""
    by_hash = {"count_by": "hash"}
    measured = R.measure(
        spark,
        [
            RuleSet("lineitem", 1, (
                Rule("U001", "uniqueness", "high", {"column": "l_orderkey", **by_hash}),
                Rule("U002", "uniqueness", "low", {"column": "l_extendedprice", "max_duplicates_allowed": 10**9, **by_hash}),
            )),
            RuleSet("pages", 1, (Rule("U003", "uniqueness", "low", {"column": "html", **by_hash}),)),
        ],
        {name: D.table(spark, folder, name) for name in ("lineitem", "pages")},
        D.AS_OF,
    )
    top = _top(measured)
    shown = F.when(F.col("rule_id") == "U003", F.md5("value")).otherwise(F.col("value"))
    return top.withColumn("value", shown)


def check_uniqueness_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts of any length; the report shows the repeated texts themselves."""
    top = _top(
        _measured(
            spark,
            {"documents": D.table(spark, folder, "documents")},
            Rule("U001", "uniqueness", "high", {"column": "text"}),
            Rule("U002", "uniqueness", "high", {"column": "doc_id"}),
        )
    )
    return top.select(
        *VERDICT, "place", F.length("value").cast("bigint").alias("length"),
        F.md5("value").alias("value_md5"), "n",
    )


def check_long_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that differ in their last characters only, from the 201st on: equal counts go by value."""
    tail = F.concat(F.repeat(F.lit("x"), F.lit(200)), (F.col("doc_id") % 50).cast("string"))
    documents = D.table(spark, folder, "documents").select(tail.alias("text"))
    allowed = ["x" * 200 + "7"]
    return _top(
        _measured(
            spark,
            {"documents": documents},
            Rule("U001", "uniqueness", "high", {"column": "text"}),
            Rule("D001", "domain", "high", {"column": "text", "allowed_values": allowed}),
        )
    )


def check_range(spark: SparkSession, folder: str) -> DataFrame:
    measured = _measured(
        spark,
        {"customer": D.customer(spark, folder)},
        Rule("R001", "range", "high", {"column": "c_acctbal", "min": 0}),
        Rule("R002", "range", "high", {"column": "c_acctbal", "min": -1000, "max": 10000}),
        Rule("R003", "range", "high", {"column": "balance_text", "min": 0, "max": 9000}),
        Rule("R004", "range", "high", {"column": "balance_text"}),
        Rule("R005", "range", "high", {"column": "c_nationkey", "max": 20}),
    )
    return measured.select(*VERDICT)


def check_domain(spark: SparkSession, folder: str) -> DataFrame:
    return _top(
        _measured(
            spark,
            {"orders": D.orders(spark, folder)},
            Rule("D001", "domain", "high", {"column": "o_orderstatus", "allowed_values": ["F", "O"]}),
            Rule("D002", "domain", "high", {"column": "o_orderpriority", "allowed_values": ["2-HIGH"]}),
            Rule("D003", "domain", "high", {"column": "o_orderpriority", "allowed_values": []}),
            Rule("D004", "domain", "low", {"column": "o_custkey", "allowed_values": [1, 2, 3]}),
        )
    )


def check_date_not_in_future(spark: SparkSession, folder: str) -> DataFrame:
    """Typed dates, and dates as text in two formats and with unreadable ones."""
    status = F.col("l_linestatus")
    text = (
        F.when(F.col("l_returnflag") == "N", F.lit("pending"))
        .when(status == "O", F.date_format("l_shipdate", "M/d/yyyy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    lineitem = D.table(spark, folder, "lineitem").withColumn("ship_text", text)
    measured = _measured(
        spark,
        {"lineitem": lineitem},
        Rule("T001", "date_not_in_future", "high", {"column": "l_shipdate"}),
        Rule("T002", "date_not_in_future", "high", {"column": "ship_text"}),
        as_of=datetime(2000, 1, 1),
    )
    return measured.select(*VERDICT)


def check_referential_integrity(spark: SparkSession, folder: str) -> DataFrame:
    datasets = {
        "lineitem": D.table(spark, folder, "lineitem"),
        "settled_orders": D.settled_orders(spark, folder),
        "orders": D.table(spark, folder, "orders"),
    }
    parent = {"child_column": "l_orderkey", "parent_column": "o_orderkey"}
    return _top(
        _measured(
            spark,
            datasets,
            Rule("K001", "referential_integrity", "high", {**parent, "parent_dataset": "settled_orders"}),
            Rule("K002", "referential_integrity", "high", {**parent, "parent_dataset": "orders"}),
        )
    )


def check_referential_integrity_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a label, and labels without a document."""
    datasets = {name: D.table(spark, folder, name) for name in ("documents", "labels")}
    key = {"child_column": "doc_id", "parent_column": "doc_id"}
    return _top(
        _measured(
            spark,
            datasets,
            Rule("K001", "referential_integrity", "high", {**key, "parent_dataset": "labels"}),
            Rule("K002", "referential_integrity", "high",
                 {**key, "parent_dataset": "documents", "child_dataset": "labels"}),
        )
    )


def check_freshness(spark: SparkSession, folder: str) -> DataFrame:
    measured = _measured(
        spark,
        {"events": D.table(spark, folder, "events")},
        Rule("F001", "freshness", "high", {"ts_column": "ts", "max_age_days": 7}),
        Rule("F002", "freshness", "high", {"ts_column": "ts", "max_age_days": 5}),
        Rule("F003", "freshness", "high", {"ts_column": "ts", "max_age_days": -1}),
        Rule("F004", "freshness", "high", {"max_age_days": 5}),
        Rule("F005", "freshness", "high", {"ts_column": "event_type", "max_age_days": 5}),
    )
    return measured.select(
        "rule_id",
        "status",
        "total",
        F.round("age_days", 4).alias("age_days"),
        F.get_json_object("observed_value", "$.error").alias("error"),
        F.get_json_object("observed_value", "$.max_ts_load_utc").alias("latest"),
    )


# --- runs -------------------------------------------------------------------


def _run(spark: SparkSession, folder: str) -> DataFrame:
    return R.run_all(spark, D.RUN_ID, D.RULESETS, D.checked(spark, folder), D.AS_OF)


def _observed(results: DataFrame) -> DataFrame:
    """Result rows with their main observed numbers as columns."""
    numbers = [F.get_json_object("observed_value", f"$.{k}") for k in ("failed", "null_count", "duplicates")]
    return results.select(
        "run_id",
        "dataset_id",
        "ruleset_version",
        "rule_id",
        "rule_type",
        "severity",
        "status",
        F.coalesce(*numbers).cast("bigint").alias("failed"),
        F.get_json_object("observed_value", "$.total").cast("bigint").alias("total"),
        F.get_json_object("observed_value", "$.error").alias("error"),
    )


def run_ruleset(spark: SparkSession, folder: str) -> DataFrame:
    """One rule set, with the JSON payloads as they are stored."""
    results = R.run_ruleset(spark, D.RUN_ID, D.ORDERS_RULES, D.checked(spark, folder), D.AS_OF)
    counted = F.col("rule_type").isin("range", "domain", "date_not_in_future")
    return _observed(results).join(
        results.select("rule_id", "threshold", F.when(counted, F.col("observed_value")).alias("payload")),
        "rule_id",
    )


def run_all(spark: SparkSession, folder: str) -> DataFrame:
    return _observed(_run(spark, folder))


def bad_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first 100 bad rows of every failed row-level rule of the order lines."""
    datasets = D.checked(spark, folder)
    clock = Clock.at(D.AS_OF)
    planned = R.plan([D.LINEITEM_RULES], datasets, clock)
    measured = R.measure(spark, [D.LINEITEM_RULES], datasets, D.AS_OF)
    failing = measured.where((F.col("status") == "fail") & (F.col("failed") > 0)).select("seq").collect()
    found = R.sample(planned, datasets, [r["seq"] for r in failing])
    fields = {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_quantity": "double", "l_returnflag": "string"}
    shown = [F.get_json_object("payload", f"$.{c}").cast(t).alias(c) for c, t in fields.items()]
    return found.select("dataset_id", "rule_id", F.col("position").cast("bigint").alias("position"), *shown)


def _violations(spark: SparkSession, datasets: dict[str, DataFrame], rule: Rule) -> DataFrame:
    planned = R.plan([RuleSet(next(iter(datasets)), 1, (rule,))], datasets, Clock.at(D.AS_OF))
    return R.violations(planned[0].checks[0], datasets)


def violations_range(spark: SparkSession, folder: str) -> DataFrame:
    rule = Rule("R001", "range", "high", {"column": "balance_text", "min": 0})
    rows = _violations(spark, {"customer": D.customer(spark, folder)}, rule)
    return rows.select("c_custkey", "c_mktsegment", "balance_text")


def violations_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    """All documents whose text occurs more than once."""
    rule = Rule("U001", "uniqueness", "high", {"column": "text"})
    rows = _violations(spark, {"documents": D.table(spark, folder, "documents")}, rule)
    return rows.select("doc_id", "lang", "source", "n_chars")


def violations_referential_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines of orders that are still pending."""
    rule = Rule("K001", "referential_integrity", "high",
                {"child_column": "l_orderkey", "parent_dataset": "settled_orders", "parent_column": "o_orderkey"})
    datasets = {
        "lineitem": D.table(spark, folder, "lineitem"),
        "settled_orders": D.settled_orders(spark, folder),
    }
    rows = _violations(spark, datasets, rule)
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


# --- reports ----------------------------------------------------------------


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return P.run_summary(_run(spark, folder))


def report_kpi(spark: SparkSession, folder: str) -> DataFrame:
    return P.kpi(_run(spark, folder))


def report_top_failures(spark: SparkSession, folder: str) -> DataFrame:
    failures = P.top_failures(_run(spark, folder))
    number = F.coalesce(
        *[F.get_json_object("observed_value", f"$.{k}") for k in ("failed", "null_count", "duplicates")]
    )
    return failures.select(
        "dataset_id", "rule_id", "severity", "rule_type", "sample_ref",
        number.cast("bigint").alias("failed"),
        F.get_json_object("observed_value", "$.error").alias("error"),
    )


def report_digest(spark: SparkSession, folder: str) -> DataFrame:
    digest = P.digest(settle(_run(spark, folder)))
    return digest.select("run_id", "headline", "status", F.posexplode("top_failures").alias("at", "f")).select(
        "run_id",
        "headline",
        "status",
        (F.col("at") + 1).cast("bigint").alias("place"),
        *[F.col(f"f.{c}").alias(c) for c in ("dataset_id", "rule_id", "severity", "rule_type")],
    )


def report_actions(spark: SparkSession, folder: str) -> DataFrame:
    todo = P.actions(_run(spark, folder))
    return todo.withColumn("notify_channels", F.array_join("notify_channels", ","))


def report_run_actions(spark: SparkSession, folder: str) -> DataFrame:
    todo = P.run_actions(_run(spark, folder))
    return todo.withColumn("notify_channels", F.array_join("notify_channels", ","))


def report_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs kept in one table; the summary of the later one."""
    datasets = D.checked(spark, folder)
    earlier = R.run_ruleset(spark, "run_20240101", D.EVENTS_RULES, datasets, datetime(2024, 1, 1))
    later = R.run_ruleset(spark, D.RUN_ID, D.EVENTS_RULES, datasets, D.AS_OF)
    return P.run_summary(P.latest_run(settle(earlier.unionByName(later))))


# --- sources and sinks ------------------------------------------------------


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/plumbline-{uuid4().hex}"


def source_csv(spark: SparkSession, folder: str) -> DataFrame:
    """A table written as CSV with null tokens, and read back through the catalog."""
    path = _new_folder(spark)
    token = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("N/A")).otherwise(F.col("c_acctbal").cast("string"))
    written = D.table(spark, folder, "customer").withColumn("c_acctbal", token)
    written.write.option("header", "true").csv(path)
    entry = {"dataset_id": "customer", "source_type": "CSV", "source_location": path}
    return load_datasets(spark, [entry])["customer"]


def source_formats(spark: SparkSession, folder: str) -> DataFrame:
    """One table written in every format a catalog knows, each loaded by its id."""
    base = _new_folder(spark)
    customer = D.table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    entries = []
    for kind in ("csv", "parquet", "orc", "json"):
        writer = customer.write.format(kind)
        (writer.option("header", "true") if kind == "csv" else writer).save(f"{base}/{kind}")
        entries.append({"dataset_id": kind, "source_type": kind.upper(), "source_location": kind})
    view = f"customer_{uuid4().hex}"
    customer.createOrReplaceTempView(view)
    entries.append({"dataset_id": "table", "source_type": "table", "source_location": view})
    loaded = [
        load_by_id(spark, entries, e["dataset_id"], base)
        .groupBy(F.lit(e["dataset_id"]).alias("format"), "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
        for e in entries
    ]
    return union_all(loaded)


def run_containment(spark: SparkSession, folder: str) -> DataFrame:
    """A rule whose column cannot be read, among rules that can: it fails alone, with its error."""
    orders = D.table(spark, folder, "orders")
    broken = orders.selectExpr("o_orderkey", "o_totalprice", "cast(concat(o_orderstatus, '?') as int) as o_code")
    rules = (
        Rule("C001", "completeness", "high", {"column": "o_orderkey"}),
        Rule("C002", "completeness", "high", {"column": "o_code"}),
        Rule("R001", "range", "low", {"column": "o_totalprice", "max": 100000}),
    )
    run = R.execute(spark, D.RUN_ID, [RuleSet("orders", 1, rules)], {"orders": broken}, None, D.AS_OF)
    observed = F.col("observed_value")
    return run.results.select(
        "rule_id",
        "status",
        F.get_json_object(observed, "$.error").alias("error"),
        F.get_json_object(observed, "$.total").cast("bigint").alias("total"),
        F.coalesce(F.get_json_object(observed, "$.failed"), F.get_json_object(observed, "$.null_count")).cast("bigint").alias("failed"),
    )


# Added to keys to make them whole numbers of 19 digits, which doubles cannot tell apart.
LARGE = 1_234_567_890_120_000_000


def check_exact_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of 19 digits through CSV, range, domain, and a reference from bigint to decimal.

    Then tenths as floats, and references between numbers without a common type: decimals
    that take more than 38 digits together, and bigint to double above 2 ** 53.
    """
    path = _new_folder(spark)
    orders = D.table(spark, folder, "orders")
    keys = orders.select((F.col("o_orderkey") + F.lit(LARGE)).alias("key"))
    keys.write.option("header", "true").csv(path)
    entry = {"dataset_id": "keys", "source_type": "csv", "source_location": path, "options": {"sep": ","}}
    datasets = load_datasets(spark, [entry])
    datasets["odd"] = keys.where("key % 2 = 1").selectExpr("cast(key as decimal(20,0)) as id")
    listed = [LARGE + n for n in range(1, 100)]
    reference = {"child_column": "key", "parent_dataset": "odd", "parent_column": "id"}
    rules = (
        Rule("R001", "range", "low", {"column": "key", "max": LARGE + 100}),
        Rule("R002", "range", "low", {"column": "id", "min": str(LARGE + 50), "max": LARGE + 1000}),
        Rule("D001", "domain", "low", {"column": "key", "allowed_values": listed}),
        Rule("U001", "uniqueness", "low", {"column": "key"}),
        Rule("K001", "referential_integrity", "low", reference),
    )
    own = RuleSet("keys", 1, tuple(r for r in rules if r.rule_id != "R002"))
    parent = RuleSet("odd", 1, tuple(r for r in rules if r.rule_id == "R002"))
    datasets["tenths"] = D.table(spark, folder, "part").selectExpr("cast(p_size / 10 as float) as tenth")
    tenths = RuleSet("tenths", 1, (
        Rule("R003", "range", "low", {"column": "tenth", "min": 0.1, "max": 2.5}),
        Rule("D002", "domain", "low", {"column": "tenth", "allowed_values": [n / 10 for n in range(1, 26)]}),
    ))
    above = orders.selectExpr(f"o_orderkey + {2**53} as n")
    datasets["above"] = above.selectExpr("n", "cast(n as decimal(38,0)) as wide")
    datasets["even"] = above.where("n % 2 = 0").selectExpr("cast(n as double) as n", "cast(n as decimal(38,20)) as wide")
    references = RuleSet("above", 1, tuple(
        Rule(rule_id, "referential_integrity", "low", {"child_column": column, "parent_dataset": "even", "parent_column": column})
        for rule_id, column in (("K002", "n"), ("K003", "wide"))
    ))
    measured = R.measure(spark, [own, parent, tenths, references], datasets, D.AS_OF)
    return measured.select("rule_id", "status", "failed", "total")


def sink_results(spark: SparkSession, folder: str) -> DataFrame:
    """A run with everything written: rules, results, samples; results read back by run."""
    base = _new_folder(spark)
    sinks.append_rules(rules_table(spark, D.RULESETS), base)
    rulesets = load_rulesets(sinks.read_rules(spark, base))
    for _ in range(2):  # a run that is repeated is replaced
        R.execute(spark, D.RUN_ID, rulesets.values(), D.checked(spark, folder), base, D.AS_OF)
    results = sinks.read_results(spark, base, D.RUN_ID)
    samples = sinks.read_samples(spark, base).groupBy("dataset_id", "rule_id").agg(
        F.count(F.lit(1)).alias("samples")
    )
    sampled = results.join(samples, ["dataset_id", "rule_id"], "left")
    return sampled.select(
        "dataset_id",
        "rule_id",
        "status",
        F.col("sample_ref").isNotNull().alias("sampled"),
        F.coalesce("samples", F.lit(0)).alias("samples"),
    )


def sink_interrupted_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run that is kept, and a second try of it that never gets to its end: the first is what is read."""
    base = _new_folder(spark)
    datasets = D.checked(spark, folder)
    R.execute(spark, D.RUN_ID, D.RULESETS, datasets, base, D.AS_OF)
    again = sinks.begin_run(spark, base, D.RUN_ID)
    sinks.append_results(sinks.read_results(spark, base, D.RUN_ID).limit(1), again)
    samples = sinks.read_samples(spark, base, D.RUN_ID).groupBy("dataset_id", "rule_id").agg(F.count(F.lit(1)).alias("samples"))
    read = sinks.read_results(spark, base).join(samples, ["dataset_id", "rule_id"], "left")
    return read.select("run_id", "dataset_id", "rule_id", "status", F.coalesce("samples", F.lit(0)).alias("samples"))


def registry_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    """Two suggestion runs that both saw the same registry: each rule set gets two new versions."""
    base = _new_folder(spark)
    existing = settle(_existing(settle(_profile(spark, folder))))
    sinks.append_rules(existing, base)
    held = settle(sinks.read_rules(spark, base))
    for made in [M.stamp_version(held, held) for _ in range(2)]:
        sinks.publish_rules(made, base)
    return sinks.read_rules(spark, base).groupBy("dataset_id", "ruleset_version", "status").agg(
        F.count(F.lit(1)).alias("rules"), F.count_distinct("rule_id").alias("rule_ids")
    )


def sink_summary(spark: SparkSession, folder: str) -> DataFrame:
    base = _new_folder(spark)
    for _ in range(2):  # a run that is repeated counts once
        sinks.append_summary(P.run_summary(_run(spark, folder)), base)
    return sinks.read_summaries(spark, base)


# --- profile and suggestions ------------------------------------------------


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile(D.profiled(spark, folder))


def _profile_columns(profiled: DataFrame) -> DataFrame:
    return profiled.select(
        "dataset_id",
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.col("column").alias("column_name"),
        "dtype",
        "row_count",
        "null_count",
        F.round("null_pct", 9).alias("null_pct"),
        "distinct_count",
        "non_null_count",
        F.round("distinct_ratio_non_null", 9).alias("distinct_ratio_non_null"),
        "max_dup_count",
        "duplicate_count",
        "min",
        "max",
        F.round("mean", 4).alias("mean"),
    )


def _profile_tops(profiled: DataFrame) -> DataFrame:
    return profiled.select(
        "dataset_id", F.col("column").alias("column_name"), F.posexplode("top_values").alias("at", "e")
    ).select(
        "dataset_id",
        "column_name",
        (F.col("at") + 1).cast("bigint").alias("place"),
        F.col("e.value").alias("value"),
        F.col("e.count").alias("n"),
    )


def profile_table(spark: SparkSession, folder: str) -> DataFrame:
    return _profile_columns(_profile(spark, folder))


def profile_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return _profile_tops(_profile(spark, folder))


def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return _profile_columns(profile({"lineitem": D.table(spark, folder, "lineitem")}))


def profile_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts are counted whole."""
    return _profile_columns(profile({"documents": D.table(spark, folder, "documents")}))


def _csv_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of two tables that a catalog has as CSV: each file is parsed once."""
    base = _new_folder(spark)
    entries = []
    for name in ("customer", "orders"):
        table = D.table(spark, folder, name)
        table.write.option("header", "true").csv(f"{base}/{name}")
        entries.append({"dataset_id": name, "source_type": "csv", "source_location": name})
    entries[-1]["schema"] = table.schema  # its moments are not inferred
    return profile(load_datasets(spark, entries, base), row_formats=row_formats(entries))


def profile_csv(spark: SparkSession, folder: str) -> DataFrame:
    return _profile_columns(_csv_profile(spark, folder))


def profile_csv_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return _profile_tops(_csv_profile(spark, folder))


#: standard errors between an estimate and the exact count
WITHIN = 4


def _sketched_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines sketched by year of shipping; one year is loaded short and then again whole."""
    base = _new_folder(spark)
    lineitem = D.table(spark, folder, "lineitem")
    late = lineitem.where("year(l_shipdate) = 1997")
    S.store(settle(S.sketch("lineitem", late.where("l_linenumber = 1"), "year(l_shipdate)")), base)
    for year in ("year(l_shipdate) < 1997", "year(l_shipdate) >= 1997"):
        S.store(settle(S.sketch("lineitem", lineitem.where(year), "year(l_shipdate)")), base)
    return S.profile_sketched(S.stored(spark, base))


def profile_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of merged yearly sketches; distinct counts next to the exact ones, within their error."""
    exact = profile({"lineitem": D.table(spark, folder, "lineitem")}).selectExpr("column", "distinct_count as exact")
    found = _sketched_lineitem(spark, folder).join(exact, "column")
    bound = F.greatest(WITHIN * F.col("distinct_error") * F.col("exact"), F.lit(1.0))
    return found.select(
        F.col("column").alias("column_name"), F.col("ordinal").cast("bigint").alias("ordinal"), "dtype", "row_count",
        "null_count", "min", "max", F.round("mean", 4).alias("mean"), F.col("exact").alias("distinct_count"),
        (F.abs(F.col("distinct_count") - F.col("exact")) <= bound).alias("within_bound"),
    )


def profile_sketched_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of three tables; only near-unique columns are then counted exactly."""
    datasets = {
        "orders": D.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        "documents": D.table(spark, folder, "documents").select("doc_id", "lang", "source"),
        "events": D.table(spark, folder, "events").select("event_id", "event_type"),
    }
    sketched = S.profile_sketched(settle(union_all([S.sketch(d, df) for d, df in datasets.items()])))
    counted = S.exact_where_it_matters(settle(sketched), datasets).where("exact")
    return counted.select(
        "dataset_id", F.col("column").alias("column_name"), "row_count", "distinct_count", "max_dup_count",
        F.round("distinct_ratio_non_null", 9).alias("distinct_ratio_non_null"), "duplicate_count",
    )


def key_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = K.key_candidates(_profile(spark, folder))
    return found.select(
        "dataset_id",
        F.col("rank").cast("bigint").alias("place"),
        F.array_join("columns", ",").alias("column_name"),
        F.round("confidence", 9).alias("confidence"),
        "evidence.row_count",
        "evidence.non_null_count",
        "evidence.distinct_count",
        "evidence.duplicate_count",
        "evidence.max_dup_count",
        F.array_join("evidence.name_signals.positive", ",").alias("positive"),
        F.array_join("evidence.name_signals.negative", ",").alias("negative"),
        F.array_join("notes", ";").alias("notes"),
    )


def key_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = K.key_rules(K.key_candidates(_profile(spark, folder)))
    return rules.withColumnRenamed("column", "column_name")


def candidates_range(spark: SparkSession, folder: str) -> DataFrame:
    found = B.range_candidates(B.column_candidates(_profile(spark, folder)))
    return found.select(
        "dataset_id", F.col("rank").cast("bigint").alias("place"), F.col("column").alias("column_name"),
        "dtype", F.round("null_pct", 9).alias("null_pct"), "min", "max", "non_null_count",
    )


def candidates_domain(spark: SparkSession, folder: str) -> DataFrame:
    found = B.domain_candidates(B.column_candidates(_profile(spark, folder)))
    return found.select(
        "dataset_id", F.col("rank").cast("bigint").alias("place"), F.col("column").alias("column_name"),
        "dtype", F.round("null_pct", 9).alias("null_pct"), "distinct_count",
        F.array_join(F.transform("top_values", lambda e: F.concat_ws(":", e["value"], e["count"].cast("string"))), "|")
        .alias("top_values"),
    )


def candidates_all(spark: SparkSession, folder: str) -> DataFrame:
    found = B.column_candidates(_profile(spark, folder))
    return found.select(
        "dataset_id", "rule_type", F.col("rank").cast("bigint").alias("place"), F.col("column").alias("column_name")
    )


def propose_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = H.propose_rules(_profile(spark, folder))
    return found.select(
        "dataset_id", "ordinal", "rule_type", F.col("column").alias("column_name"), "severity", "params",
        F.col("confidence").cast("double").alias("confidence"), "rationale", "evidence_used",
    )


TEMPLATES = (
    H.Template(
        "orders", "O", required_columns=("o_orderkey", "o_custkey"), key_column="o_orderkey",
        not_null={"o_orderkey": "critical", "o_orderpriority": "high"}, domain_column="o_orderpriority",
        domain_max_length=8, range_column="o_totalprice", range_cap=True, date_column="o_orderdate",
        ts_column="o_orderdate", max_age_days=2,
    ),
    H.Template(
        "part", "P", required_columns=("p_partkey",), key_column="p_partkey", not_null={"p_name": "high"},
        domain_column="p_type", range_column="p_size",
    ),
)


def template_rules(spark: SparkSession, folder: str) -> DataFrame:
    return H.template_rules(spark, _profile(spark, folder), TEMPLATES)


def _catalog(profiled: DataFrame) -> DataFrame:
    """A catalog entry per profiled table: what is complete is required, the first date column is
    the load time."""
    complete = F.array_sort(F.collect_list(F.when(F.col("null_count") == 0, F.struct("ordinal", "column"))))
    dates = F.min(F.when(F.contains("dtype", F.lit("datetime")), F.col("column")))
    found = profiled.groupBy("dataset_id").agg(complete.alias("complete"), dates.alias("ts_load_column"))
    return found.select(
        "dataset_id",
        F.lit("Sales").alias("owner_team"),
        F.lit(None).cast("string").alias("data_owner"),
        F.when(F.col("ts_load_column").isNotNull(), F.col("complete.column")).alias("required_columns"),
        "ts_load_column",
        F.when(F.col("ts_load_column").isNotNull(), F.lit("2")).otherwise(F.lit("soon")).alias("freshness_max_age_days"),
        F.lit(None).cast("string").alias("freshness_severity"),
    )


def baseline_rules(spark: SparkSession, folder: str) -> DataFrame:
    catalog = _catalog(settle(_profile(spark, folder)))
    held = spark.createDataFrame([("part", "schema")], "dataset_id string, rule_type string")
    implied = H.baseline_rules(catalog, held, "updated_at")
    return implied.select(
        "dataset_id", "rule_id", "rule_type", "severity", "expectation", "description", "suggested_by"
    )


def _existing(profiled: DataFrame) -> DataFrame:
    """Rules already held: a completeness rule per column, and a domain one for short lists."""
    listed = F.size("top_values")
    return M.as_rules(
        profiled.select(
            "dataset_id",
            F.lit(4).alias("ruleset_version"),
            F.lit("active").alias("status"),
            F.col("ordinal") + 1,
            F.format_string("C%03d", F.col("ordinal") * 2 + 1).alias("rule_id"),
            F.lit("completeness").alias("rule_type"),
            F.lit("high").alias("severity"),
            F.to_json(F.struct("column")).alias("expectation"),
        )
        .withColumnRenamed("(ordinal + 1)", "ordinal")
        .unionByName(
            profiled.where((F.col("distinct_count") == listed) & (F.col("dtype") == "object")).select(
                "dataset_id",
                F.lit(4).alias("ruleset_version"),
                F.lit("active").alias("status"),
                (F.col("ordinal") + 100).alias("ordinal"),
                F.format_string("D%03d", F.col("ordinal") + 1).alias("rule_id"),
                F.lit("domain").alias("rule_type"),
                F.lit("high").alias("severity"),
                F.to_json(
                    F.struct(F.reverse(F.col("top_values.value")).alias("allowed_values"), F.col("column"))
                ).alias("expectation"),
            )
        )
    )


def _offered(profiled: DataFrame) -> DataFrame:
    """Proposals of good and bad kinds for every column of the profile."""
    doubt = F.when(F.col("null_count") > 0, F.lit("0.4")).otherwise(F.lit("0.9"))
    shapes = [
        ("completeness", "column", "null", "'{}'"),
        ("uniqueness", "null", "array(column)", "null"),
        ("uniqueness", "null", "array(column, dataset_id)", "'{}'"),
        ("uniqueness", "column", "null", """'{"max_duplicates_allowed": 5}'"""),
        ("range", "column", "null", """'{"max": 10, "min": 0.0}'"""),
        ("range", "column", "null", """'{"min": 0, "max": 10}'"""),
        ("range", "column", "null", """'{"step": 2}'"""),
        ("domain", "column", "null", "to_json(struct(top_values.value as allowed_values))"),
        ("domain", "upper(column)", "null", """'{"allowed_values": []}'"""),
        ("monotonic", "column", "null", "'{}'"),
        ("date_not_in_future", "column", "null", "'[1]'"),
        ("date_not_in_future", "'  '", "null", "null"),
    ]
    entries = ", ".join(
        f"struct({kind} as kind, '{rule_type}' as rule_type, cast({column} as string) as col, "
        f"cast({columns} as array<string>) as cols, cast({params} as string) as params)"
        for kind, (rule_type, column, columns, params) in enumerate(shapes)
    )
    return H.as_proposals(
        profiled.withColumn("confidence", doubt)
        .selectExpr("dataset_id", "ordinal as place", "confidence", f"inline(array({entries}))")
        .selectExpr(
            "dataset_id", "cast(place * 100 + kind as bigint) as ordinal", "rule_type", "col as column",
            "cols as columns", "params", "confidence",
        )
    )


def _judged(spark: SparkSession, folder: str, cap: int) -> tuple[DataFrame, DataFrame]:
    profiled = settle(_profile(spark, folder))
    existing = settle(_existing(profiled))
    columns = profiled.select("dataset_id", "column")
    judged = G.judge_proposals(
        settle(_offered(profiled)), columns, existing, max_rules_to_add=cap, min_confidence=0.5
    )
    return judged, existing


def proposal_guardrails(spark: SparkSession, folder: str) -> DataFrame:
    judged, _ = _judged(spark, folder, 15)
    return judged.select(
        "dataset_id", "ordinal", "rule_type", F.col("column").alias("column_name"), "decision", "reject_reason"
    )


def merge_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, existing = _judged(spark, folder, 12)
    accepted = settle(judged.where(F.col("decision") == "accepted"))
    merged = M.merge_rules(existing, accepted, M.PATCH_AUTHOR)
    stamped = M.stamp_version(merged, existing)
    return stamped.select(
        "dataset_id",
        "ruleset_version",
        "status",
        "rule_id",
        "rule_type",
        "severity",
        F.get_json_object("expectation", "$.column").alias("column_name"),
        "suggested_by",
        "ai_confidence",
    )


def registry_current(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of the rule sets in one table; the highest one that is active."""
    existing = _existing(settle(_profile(spark, folder)))
    older = existing.withColumn("ruleset_version", F.lit(3))
    draft = existing.withColumns({"ruleset_version": F.lit(5), "status": F.lit("suggested")})
    live = current_rules(older.unionByName(existing).unionByName(draft))
    return live.select("dataset_id", "ruleset_version", "status", "rule_id", "rule_type")


def validate_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Proposals of all kinds taken over as rules without any guardrail."""
    profiled = settle(_profile(spark, folder))
    offered = _offered(profiled).select(
        "dataset_id",
        "ordinal",
        F.lit(1).alias("ruleset_version"),
        F.format_string("X%03d", "ordinal").alias("rule_id"),
        F.when(F.col("rule_type") != "completeness", F.col("rule_type")).alias("rule_type"),
        F.lit("low").alias("severity"),
        M._expectation().alias("expectation"),
    )
    return M.validate_rules(M.as_rules(offered))


def suggest_rulesets(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way from tables to the next version of their rule sets."""
    datasets = D.profiled(spark, folder)
    entries = [
        {"dataset_id": "orders", "source_type": "parquet", "source_location": "", "owner_team": "Sales",
         "ts_load_column": "o_orderdate", "freshness_max_age_days": 2},
        {"dataset_id": "customer", "source_type": "parquet", "source_location": "",
         "required_columns": ["c_custkey", "c_name"]},
        {"dataset_id": "part", "source_type": "parquet", "source_location": ""},
    ]
    empty = spark.createDataFrame([], RULES_SCHEMA)
    made = suggest(spark, entries, datasets, empty).rules
    return made.select(
        "dataset_id", "ruleset_version", "status", "owner_team", F.col("ordinal"), "rule_id", "rule_type",
        "severity", "suggested_by", F.coalesce(
            F.get_json_object("expectation", "$.column"), F.get_json_object("expectation", "$.ts_column")
        ).alias("column_name"),
    )


def sink_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    """Judged proposals and merged rules written to the registry, and counted from there."""
    base = _new_folder(spark)
    judged, existing = _judged(spark, folder, 12)
    sinks.append_audit(judged, base)
    kept = sinks.read_audit(spark, base)
    accepted = kept.where(F.col("decision") == "accepted").drop("judged_at")
    sinks.append_rules(existing, base)
    sinks.append_rules(M.stamp_version(M.merge_rules(existing, accepted, M.PATCH_AUTHOR), existing), base)
    written = sinks.read_rules(spark, base)
    rules = written.groupBy("dataset_id").agg(
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if(F.col("status") == "suggested").alias("suggested"),
        F.max("ruleset_version").alias("latest_version"),
    )
    return rules.join(G.decision_counts(kept), "dataset_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        check_schema,
        check_completeness,
        check_uniqueness,
        check_uniqueness_suspects,
        check_uniqueness_text,
        check_long_texts,
        check_range,
        check_domain,
        check_date_not_in_future,
        check_referential_integrity,
        check_referential_integrity_documents,
        check_freshness,
        run_ruleset,
        run_all,
        bad_samples,
        violations_range,
        violations_uniqueness,
        violations_referential_integrity,
        run_summary,
        report_kpi,
        report_top_failures,
        report_digest,
        report_actions,
        report_run_actions,
        report_latest,
        source_csv,
        source_formats,
        run_containment,
        check_exact_numbers,
        sink_results,
        sink_interrupted_run,
        registry_two_writers,
        sink_summary,
        sink_suggestions,
        profile_table,
        profile_top_values,
        profile_lineitem,
        profile_documents,
        profile_csv,
        profile_csv_top_values,
        profile_sketched,
        profile_sketched_keys,
        key_candidates,
        key_rules,
        candidates_range,
        candidates_domain,
        candidates_all,
        propose_rules,
        template_rules,
        baseline_rules,
        proposal_guardrails,
        merge_rules,
        registry_current,
        validate_rules,
        suggest_rulesets,
    )
}
