"""From tables to suggested rule sets, for all datasets of a catalog at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.model import RULE_TYPES
from plumbline.operators.candidates import CandidateLimits
from plumbline.operators.guardrails import decision_counts, judge_proposals
from plumbline.operators.key_detection import STANDARD_POLICY, KeyPolicy, key_candidates, key_rules
from plumbline.operators.merging import (
    KEY_AUTHOR,
    PATCH_AUTHOR,
    as_rules,
    merge_rules,
    stamp_version,
)
from plumbline.operators.profile import profile
from plumbline.operators.proposals import MAX_LISTED_VALUES, MAX_RULES_TO_ADD, baseline_rules, propose_rules
from plumbline.session import settle
from plumbline.sources.catalog import catalog_table, row_formats
from plumbline.sources.registry import current_rules

# Key rules are not capped: there are at most two per key candidate.
NO_CAP = 2**31 - 1


@dataclass(frozen=True)
class Suggestion:
    profile: DataFrame
    key_candidates: DataFrame
    decisions: DataFrame
    rules: DataFrame
    summary: DataFrame


def suggest(
    spark: SparkSession,
    catalog: Iterable[Mapping[str, Any]],
    datasets: Mapping[str, DataFrame],
    rules: DataFrame,
    policy: KeyPolicy = STANDARD_POLICY,
    limits: CandidateLimits = CandidateLimits(),
    proposals: DataFrame | None = None,
    max_rules_to_add: int = MAX_RULES_TO_ADD,
    min_confidence: float | None = None,
    default_ts_column: str | None = None,
) -> Suggestion:
    """Profile, detect keys, propose, judge and merge; returns the next rule sets.

    ``proposals`` replaces the heuristics by proposals from elsewhere.  The data is
    scanned once, for the profile; all later steps work on tables with a row per
    column or rule, settled between steps so that none is computed twice.
    """
    entries = [e for e in catalog if e["dataset_id"] in datasets]
    profiled = settle(profile(datasets, MAX_LISTED_VALUES, row_formats(entries)))
    columns = profiled.select("dataset_id", "column")
    wanted = catalog_table(spark, entries)
    existing = current_rules(rules).join(
        wanted.select("dataset_id"), "dataset_id", "left_semi"
    )

    implied = baseline_rules(wanted, existing, default_ts_column)
    ends = existing.groupBy("dataset_id").agg(
        F.max("ordinal").alias("__end"), F.max("ruleset_version").alias("ruleset_version")
    )
    placed = implied.join(ends, "dataset_id", "left").withColumns(
        {
            "ordinal": F.coalesce("__end", F.lit(0)) + F.col("ordinal"),
            "ruleset_version": F.coalesce("ruleset_version", F.lit(1)),
        }
    )
    document = settle(as_rules(existing).unionByName(as_rules(placed)))

    keys = settle(key_candidates(profiled, policy))
    judged_keys = judge_proposals(key_rules(keys), columns, document, RULE_TYPES, NO_CAP)
    accepted_keys = settle(judged_keys.where(F.col("decision") == "accepted"))
    document = settle(merge_rules(document, accepted_keys, KEY_AUTHOR, "high"))

    offered = propose_rules(profiled, RULE_TYPES, limits, max_rules_to_add) if proposals is None else proposals
    decisions = settle(
        judge_proposals(offered, columns, document, RULE_TYPES, max_rules_to_add, min_confidence)
    )
    accepted = decisions.where(F.col("decision") == "accepted")
    merged = merge_rules(document, accepted, PATCH_AUTHOR, "medium")
    suggested = settle(_with_owner(stamp_version(merged, rules), wanted))

    found = keys.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("key_candidates"))
    versions = suggested.groupBy("dataset_id").agg(
        F.max("ruleset_version").alias("ruleset_version"), F.count(F.lit(1)).alias("rules")
    )
    zero = F.lit(0).cast("bigint")
    summary = (
        versions.join(found, "dataset_id", "left")
        .join(decision_counts(decisions), "dataset_id", "left")
        .select(
            "dataset_id",
            "ruleset_version",
            "rules",
            *[F.coalesce(c, zero).alias(c) for c in ("key_candidates", "accepted", "rejected")],
        )
    )
    return Suggestion(profiled, keys, decisions, suggested, summary)


def _with_owner(rules: DataFrame, catalog: DataFrame) -> DataFrame:
    """Fill in the owners of new rule sets from the catalog."""
    owners = catalog.select(
        "dataset_id", F.col("owner_team").alias("__team"), F.col("data_owner").alias("__owner")
    )
    unknown = F.lit("UNKNOWN")
    filled = rules.join(owners, "dataset_id", "left").withColumns(
        {
            "owner_team": F.coalesce("owner_team", "__team", unknown),
            "data_owner": F.coalesce("data_owner", "__owner", unknown),
        }
    )
    return as_rules(filled)
