"""Which columns each rule type could apply to, from the profile table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CandidateLimits:
    # The thresholds and caps that apply where a policy names none.
    domain_threshold: int = 50
    uniqueness_threshold: float = 0.8
    max_range: int = 20
    max_domain: int = 20


# What makes a column name look like a date, and a type a number.
DATE_NAME_PARTS = ("date", "dt", "ts", "time", "timestamp")
DATE_NAME_ENDINGS = ("_at", "_time")
NUMBER_TYPE_PARTS = ("int", "float", "number")

CANDIDATE_TYPES = ("range", "domain", "completeness", "uniqueness", "date_not_in_future")


def _any_in(text: str, parts: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({text}, '{p}')" for p in parts) + ")"


def column_candidates(
    profile: DataFrame,
    allowed_rule_types: tuple[str, ...] = CANDIDATE_TYPES,
    limits: CandidateLimits = CandidateLimits(),
) -> DataFrame:
    """One row per (dataset, rule type, column) that qualifies, ``rank`` giving the order.

    The profile is read once: each column lists the rule types it qualifies for.  A
    dataset has as many rows here as it has columns, so ranking it is small.
    """
    endings = " or ".join(f"endswith(lower(column), '{e}')" for e in DATE_NAME_ENDINGS)
    tests = {
        "range": f"{_any_in('dtype', NUMBER_TYPE_PARTS)} and (min is not null or max is not null)",
        "domain": f"distinct_count between 1 and {limits.domain_threshold}",
        "completeness": "true",
        "uniqueness": f"distinct_ratio_non_null >= {limits.uniqueness_threshold}D",
        "date_not_in_future": (
            f"{_any_in('lower(column)', DATE_NAME_PARTS)} or {endings} or contains(dtype, 'datetime')"
        ),
    }
    keys = {
        "range": "-abs(coalesce(max, 0D) - coalesce(min, 0D))",
        "domain": "cast(distinct_count as double)",
    }
    entries = [
        f"if({tests[t]}, struct('{t}' as rule_type, {keys.get(t, '0D')} as sort_key), null)"
        for t in CANDIDATE_TYPES
        if t in allowed_rule_types
    ]
    if not entries:
        return profile.where(F.lit(False)).selectExpr(
            "'' as rule_type", "0 as rank", "*"
        )
    qualified = profile.selectExpr("*", f"inline(array_compact(array({', '.join(entries)})))")
    order = Window.partitionBy("dataset_id", "rule_type").orderBy("sort_key", "ordinal")
    cap = F.when(F.col("rule_type") == "range", limits.max_range).when(
        F.col("rule_type") == "domain", limits.max_domain
    )
    ranked = qualified.withColumn("rank", F.row_number().over(order)).drop("sort_key")
    return ranked.where(cap.isNull() | (F.col("rank") <= cap))


def range_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rule_type") == "range").select(
        "dataset_id", "rank", "column", "dtype", "null_pct", "min", "max", "non_null_count"
    )


def domain_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rule_type") == "domain").select(
        "dataset_id", "rank", "column", "dtype", "null_pct", "distinct_count", "top_values"
    )


def completeness_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rule_type") == "completeness").select(
        "dataset_id", "rank", "column", "dtype", "null_pct", "non_null_count"
    )


def uniqueness_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rule_type") == "uniqueness").select(
        "dataset_id",
        "rank",
        "column",
        "dtype",
        "distinct_count",
        "distinct_ratio_non_null",
        "duplicate_count",
        "non_null_count",
    )


def date_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("rule_type") == "date_not_in_future").select(
        "dataset_id", "rank", "column", "dtype", "null_pct", "non_null_count"
    )
