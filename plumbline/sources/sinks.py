"""Where runs are kept: result rows, bad-row samples, summaries, rules, audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.model import RESULT_COLUMNS, RESULTS_SCHEMA, RULES_SCHEMA, SAMPLES_SCHEMA
from plumbline.sources.generations import Generation, begin, folder_of, read_committed, take_number, vacuum

RUN_TABLES = ("rule_results", "bad_samples")


def begin_run(spark: SparkSession, results_dir: str, run_id: str) -> Generation:
    """A place for everything a run writes; readers see it when it is committed, and not before.

    A run id that is already there is replaced at that moment, its samples included.
    """
    return begin(spark, results_dir, "run_id", run_id)


def sample_folder(run: Generation, dataset_id: str, rule_id: str) -> str:
    """Where the bad rows of one rule of a run are."""
    return "/".join([run.folder("bad_samples"), folder_of("dataset_id", dataset_id), folder_of("rule_id", rule_id)])


def append_results(results: DataFrame, run: Generation) -> None:
    """Result rows of a run, one folder per dataset."""
    run.append(results, "rule_results", "dataset_id")


def append_samples(samples: DataFrame, run: Generation) -> None:
    """Bad-row samples, one folder per rule; the sample itself is a JSON payload."""
    run.append(samples, "bad_samples", "dataset_id", "rule_id")


def write_results(results: DataFrame, results_dir: str, run_id: str) -> None:
    """The result rows of one run, without samples, in the place of all it had before."""
    run = begin_run(results.sparkSession, results_dir, run_id)
    append_results(results, run)
    run.commit()


def vacuum_runs(spark: SparkSession, results_dir: str) -> int:
    """Remove what repeated runs have replaced."""
    return vacuum(spark, results_dir, "run_id", RUN_TABLES)


def append_summary(summary: DataFrame, results_dir: str) -> None:
    """Summaries as JSON; read them with ``read_summaries``, which takes the last of each run."""
    stamped = summary.withColumn("written_at", F.current_timestamp())
    stamped.write.mode("append").json(f"{results_dir}/run_summaries")


def read_summaries(spark: SparkSession, results_dir: str) -> DataFrame:
    """One summary per run id: a run that was repeated counts once, as it was last."""
    table = spark.read.json(f"{results_dir}/run_summaries")
    others = [c for c in table.columns if c not in ("run_id", "written_at")]
    last = F.max_by(F.struct(*others), "written_at").alias("last")
    return table.groupBy("run_id").agg(last).select("run_id", "last.*")


def append_rules(rules: DataFrame, registry_dir: str) -> None:
    rules.write.mode("append").parquet(f"{registry_dir}/rules")


def append_audit(decisions: DataFrame, registry_dir: str) -> None:
    """Judged proposals, accepted and rejected, with the time they were judged."""
    decisions = decisions.withColumn("judged_at", F.current_timestamp())
    decisions.write.mode("append").parquet(f"{registry_dir}/proposal_audit")


def publish_rules(rules: DataFrame, registry_dir: str) -> DataFrame:
    """Write rule sets under version numbers that no other writer has, and return them.

    A dataset's version is the one its rules ask for or, if that is taken, the next that is
    free: a number is taken by a marker that only one writer can create.  A writer that
    dies leaves a gap.  There is one marker, and one small row on the driver, per rule set.
    """
    spark = rules.sparkSession
    asked = rules.groupBy("dataset_id").agg(F.max("ruleset_version").alias("asked")).collect()
    taken = [
        (r["dataset_id"], take_number(spark, f"{registry_dir}/_versions/{folder_of('dataset_id', r['dataset_id'])}", r["asked"] or 1))
        for r in asked
    ]
    numbers = spark.createDataFrame(taken, "dataset_id string, __number int")
    numbered = rules.join(numbers, "dataset_id").withColumn("ruleset_version", F.col("__number"))
    published = numbered.select(*RULES_SCHEMA.names)
    append_rules(published, registry_dir)
    return published


def read_results(spark: SparkSession, results_dir: str, run_id: str | None = None) -> DataFrame:
    """Result rows of all committed runs, or of one run over all its datasets.

    The declared schema keeps ids that look like numbers as text.
    """
    table = read_committed(spark, results_dir, "rule_results", "run_id", RESULTS_SCHEMA, run_id)
    return table.select(*RESULT_COLUMNS, "seq")


def read_samples(spark: SparkSession, results_dir: str, run_id: str | None = None) -> DataFrame:
    return read_committed(spark, results_dir, "bad_samples", "run_id", SAMPLES_SCHEMA, run_id)


def read_rules(spark: SparkSession, registry_dir: str) -> DataFrame:
    return spark.read.schema(RULES_SCHEMA).parquet(f"{registry_dir}/rules")


def read_audit(spark: SparkSession, registry_dir: str) -> DataFrame:
    return spark.read.parquet(f"{registry_dir}/proposal_audit")
