"""Reports over the result rows of any number of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What each severity asks for when a rule fails.
SEVERITY_POLICY = (
    ("critical", True, ("teams", "email", "ado"), True),
    ("high", False, ("teams", "email"), False),
    ("medium", False, ("teams",), False),
    ("low", False, (), False),
)
# The layout of the severity policy, and the headline below.
POLICY_LAYOUT = (
    "severity string, stop_pipeline boolean, notify_channels array<string>, "
    "create_ado_task boolean"
)

# The lengths of the failure list and of the digest.
TOP_FAILURES = 50
DIGEST_ITEMS = 20


def _summary_columns() -> list:
    failed = F.count_if(F.col("status") == "fail")
    critical = F.count_if((F.col("status") == "fail") & (F.col("severity") == "critical"))
    return [F.count(F.lit(1)).alias("total_rules"), failed.alias("failed"), critical.alias("failed_critical")]


def _scored(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "run_id",
        "case when failed_critical > 0 then 'fail' when failed > 0 then 'warn' else 'pass' end as status",
        """if(total_rules = 0, 100D,
              bround(greatest(0D, 100D - 100D * try_divide(failed, total_rules)), 2)) as score""",
        "total_rules",
        "failed",
        "failed_critical",
    )


def run_summary(results: DataFrame, run_id: str | None = None) -> DataFrame:
    """Score and status per run; with a ``run_id`` one row even if it has no results."""
    if run_id is None:
        return _scored(results.groupBy("run_id").agg(*_summary_columns()))
    one = results.where(F.col("run_id") == run_id).agg(*_summary_columns())
    return _scored(one.withColumn("run_id", F.lit(run_id)))


def latest_run(results: DataFrame) -> DataFrame:
    """The results of the run whose id sorts last."""
    last = results.agg(F.max("run_id").alias("run_id"))
    return results.join(F.broadcast(last), "run_id", "left_semi")


def kpi(results: DataFrame) -> DataFrame:
    return (
        results.groupBy("dataset_id", "severity", "status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("dataset_id", "severity", "status")
    )


def top_failures(results: DataFrame, limit: int = TOP_FAILURES) -> DataFrame:
    """The first failures of each run, in the order the rules ran."""
    order = Window.partitionBy("run_id").orderBy("seq")
    return (
        results.where(F.col("status") == "fail")
        .withColumn("__place", F.row_number().over(order))
        .where(F.col("__place") <= limit)
        .orderBy("run_id", "seq")
        .select("dataset_id", "rule_id", "severity", "rule_type", "sample_ref", "observed_value")
    )


def digest(results: DataFrame, items: int = DIGEST_ITEMS) -> DataFrame:
    """(run_id, headline, status, top_failures) per run, ready to be sent."""
    counts = results.groupBy("run_id").agg(
        *_summary_columns(), F.count_distinct("dataset_id").alias("datasets")
    )
    order = Window.partitionBy("run_id").orderBy("seq")
    first = (
        results.where(F.col("status") == "fail")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= items)
        .groupBy("run_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("place", "dataset_id", "rule_id", "severity", "rule_type", "sample_ref")
                )
            ).alias("found")
        )
    )
    return counts.join(first, "run_id", "left").selectExpr(
        "run_id",
        """case when failed_critical > 0 then 'FAIL' when failed > 0 then 'WARN' else 'PASS' end
           as status""",
        "datasets",
        "failed",
        """transform(coalesce(found, array()), f -> struct(
             f.dataset_id, f.rule_id, f.severity, f.rule_type, f.sample_ref)) as top_failures""",
    ).selectExpr(
        "run_id",
        """format_string('[DQ] Local run result: %s | datasets=%d | failed_rules=%d',
             status, datasets, failed) as headline""",
        "status",
        "top_failures",
    )


def actions(results: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Failed rules with what their severity asks for."""
    if policy is None:
        policy = F.broadcast(severity_policy(results))
    failed = results.where(F.col("status") == "fail")
    return failed.join(policy, "severity", "left").select(
        "run_id",
        "dataset_id",
        "rule_id",
        "severity",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("stop_pipeline", "create_ado_task")],
        F.coalesce("notify_channels", F.array().cast("array<string>")).alias("notify_channels"),
    )


def severity_policy(results: DataFrame) -> DataFrame:
    """The four rows of the severity policy as a table."""
    rows = [(s, stop, list(channels), task) for s, stop, channels, task in SEVERITY_POLICY]
    return results.sparkSession.createDataFrame(rows, POLICY_LAYOUT)


def run_actions(results: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Per run: whether to stop, whom to notify, whether to open a task."""
    return (
        actions(results, policy)
        .groupBy("run_id")
        .agg(
            F.max("stop_pipeline").alias("stop_pipeline"),
            F.max("create_ado_task").alias("create_ado_task"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("notify_channels")))).alias(
                "notify_channels"
            ),
        )
    )
