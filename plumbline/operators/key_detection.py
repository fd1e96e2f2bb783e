"""Likely key columns of every profiled dataset, with a confidence.

All of it is column arithmetic over the profile table, so one pass covers the
datasets of a whole lake.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import clamp, matching_patterns, safe_ratio


@dataclass(frozen=True)
class KeyPolicy:
    """Thresholds and weights of key detection."""

    enabled: bool = True
    max_candidates: int = 3
    null_pct_max: float = 0.02
    distinct_ratio_min: float = 0.999
    allow_near_unique: bool = True
    near_max_duplicates: int = 0
    near_max_duplicate_rate: float = 0.0
    near_distinct_ratio_min: float | None = None
    use_name_hints: bool = True
    positive_patterns: tuple[str, ...] = ()
    negative_patterns: tuple[str, ...] = ()
    weights: Mapping[str, float] = field(default_factory=dict)
    min_confidence_to_return: float = 0.0

    @classmethod
    def of(cls, standards: Mapping[str, Any]) -> KeyPolicy:
        """From a standards document; without a key-detection section it is disabled."""
        section = (standards.get("suggestions") or {}).get("key_detection")
        if not section:
            return cls(enabled=False)
        near = section.get("near_unique") or {}
        hints = section.get("name_hints") or {}
        scoring = section.get("scoring") or {}
        floors = scoring.get("floors") or {}
        ratio = near.get("distinct_ratio_min")
        return cls(
            enabled=bool(section.get("enabled", True)),
            max_candidates=int(section.get("max_candidates", 3)),
            null_pct_max=float(section.get("null_pct_max", 0.02)),
            distinct_ratio_min=float(section.get("distinct_ratio_min", 0.999)),
            allow_near_unique=bool(section.get("allow_near_unique", True)),
            near_max_duplicates=int(near.get("max_duplicates", 0)),
            near_max_duplicate_rate=float(near.get("max_duplicate_rate", 0.0)),
            near_distinct_ratio_min=None if ratio is None else float(ratio),
            use_name_hints=bool(section.get("use_name_hints", True)),
            positive_patterns=tuple(hints.get("positive_patterns") or ()),
            negative_patterns=tuple(hints.get("negative_patterns") or ()),
            weights=dict(scoring.get("weights") or {}),
            min_confidence_to_return=float(floors.get("min_confidence_to_return", 0.0)),
        )

    def weight(self, name: str) -> float:
        return float(self.weights.get(name, WEIGHTS[name]))


# The weights that apply where a policy names none.
WEIGHTS = {
    "exact_unique": 0.6,
    "near_unique": 0.4,
    "distinct_ratio": 0.2,
    "low_nulls": 0.1,
    "positive_name_hint": 0.1,
    "negative_name_hint": -0.2,
}

# The standard policy.
STANDARD_POLICY = KeyPolicy(
    enabled=True,
    max_candidates=3,
    null_pct_max=0.02,
    distinct_ratio_min=0.85,
    allow_near_unique=True,
    near_max_duplicates=5000,
    near_max_duplicate_rate=0.05,
    near_distinct_ratio_min=0.75,
    use_name_hints=True,
    positive_patterns=("(^|_)id$", "uuid", "guid", "surrogate", "key"),
    negative_patterns=("date", "dt", "ts", "status", "type", "code"),
    weights=WEIGHTS,
    min_confidence_to_return=0.55,
)

# The fields of the evidence; the texts of the notes further down are fixed too.
EVIDENCE = (
    "row_count",
    "non_null_count",
    "null_pct",
    "distinct_count",
    "distinct_ratio_non_null",
    "duplicate_count",
    "max_dup_count",
)


def key_candidates(profile: DataFrame, policy: KeyPolicy = STANDARD_POLICY) -> DataFrame:
    """(dataset_id, rank, candidate_type, columns, confidence, evidence, notes)."""
    ratio, non_null = F.col("distinct_ratio_non_null"), F.col("non_null_count")
    duplicates, nulls = F.col("duplicate_count"), F.col("null_pct")
    loosest = policy.distinct_ratio_min
    if policy.allow_near_unique and policy.near_distinct_ratio_min is not None:
        loosest = min(loosest, policy.near_distinct_ratio_min)
    pool = profile.where(
        F.lit(policy.enabled)
        & (non_null >= F.col("row_count") * F.lit(policy.distinct_ratio_min))
        & (nulls <= policy.null_pct_max)
        & (ratio >= loosest)
    )

    exact = duplicates == 0
    near = F.lit(policy.allow_near_unique)
    if policy.near_max_duplicates > 0:
        near = near & (duplicates <= policy.near_max_duplicates)
    if policy.near_max_duplicate_rate > 0:
        rate = safe_ratio(duplicates, non_null, empty=1.0)
        near = near & (rate <= policy.near_max_duplicate_rate)

    hints = policy.use_name_hints
    positive = matching_patterns(F.col("column"), policy.positive_patterns if hints else ())
    negative = matching_patterns(F.col("column"), policy.negative_patterns if hints else ())
    distinctness = clamp(
        (ratio - policy.distinct_ratio_min) / max(1e-9, 1.0 - policy.distinct_ratio_min)
    )
    fullness = clamp(F.lit(1.0) - nulls / max(1e-9, policy.null_pct_max))
    uniqueness = (
        F.when(exact, policy.weight("exact_unique"))
        .when(near, policy.weight("near_unique"))
        .otherwise(0.0)
    )
    score = (
        uniqueness
        + F.lit(policy.weight("distinct_ratio")) * distinctness
        + F.lit(policy.weight("low_nulls")) * fullness
        + F.when(F.size(positive) > 0, policy.weight("positive_name_hint")).otherwise(0.0)
        + F.when(F.size(negative) > 0, policy.weight("negative_name_hint")).otherwise(0.0)
    )
    repeats = F.col("max_dup_count")
    # fixed texts
    notes = F.array_compact(
        F.array(
            F.when(~exact & near, F.lit("near-unique (within near-unique thresholds)")),
            F.when(~exact & ~near, F.lit("duplicates exceed near-unique thresholds")),
            F.when(repeats > 1, F.format_string("max_dup_count=%d", repeats)),
        )
    )
    signals = F.struct(positive.alias("positive"), negative.alias("negative"))
    scored = pool.select(
        "dataset_id",
        "ordinal",
        F.lit("single").alias("candidate_type"),
        F.array("column").alias("columns"),
        clamp(score).alias("confidence"),
        F.struct(*EVIDENCE, signals.alias("name_signals")).alias("evidence"),
        notes.alias("notes"),
    ).where(F.col("confidence") >= policy.min_confidence_to_return)
    order = Window.partitionBy("dataset_id").orderBy(F.desc("confidence"), F.asc("ordinal"))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= policy.max_candidates).drop("ordinal")


def key_rules(candidates: DataFrame) -> DataFrame:
    """Two recommended rules per key candidate, as proposals."""
    return candidates.selectExpr(
        "dataset_id",
        "posexplode(array('uniqueness', 'completeness')) as (place, rule_type)",
        "rank",
        "columns[0] as column",
    ).selectExpr(
        "dataset_id",
        "cast((rank - 1) * 2 + place + 1 as bigint) as ordinal",
        "rule_type",
        "column",
        "'high' as severity",
    )
