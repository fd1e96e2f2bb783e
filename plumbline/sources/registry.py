"""Rule sets: from documents and tables, and back."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.model import RULES_SCHEMA, Rule, RuleSet, rule_rows


def rulesets_from_documents(documents: Iterable[Mapping[str, Any]]) -> dict[str, RuleSet]:
    """Rule sets by dataset; of several versions of one dataset the highest counts."""
    chosen: dict[str, RuleSet] = {}
    for document in documents:
        ruleset = RuleSet.of(document)
        held = chosen.get(ruleset.dataset_id)
        if held is None or ruleset.ruleset_version >= held.ruleset_version:
            chosen[ruleset.dataset_id] = ruleset
    return chosen


def rules_table(
    spark: SparkSession, rulesets: Iterable[RuleSet], status: str = "active"
) -> DataFrame:
    return spark.createDataFrame(rule_rows(rulesets, status), RULES_SCHEMA)


def current_rules(rules: DataFrame, status: str = "active") -> DataFrame:
    """The rules of the highest version of each dataset that has the given status."""
    live = rules.where(F.col("status") == status)
    latest = live.groupBy("dataset_id").agg(F.max("ruleset_version").alias("ruleset_version"))
    return live.join(latest, ["dataset_id", "ruleset_version"], "left_semi")


def load_rulesets(
    rules: DataFrame, dataset_ids: Iterable[str] | None = None, status: str = "active"
) -> dict[str, RuleSet]:
    """Rule sets to run.  Rules become plan expressions, so they are needed on the driver;
    ``dataset_ids`` limits them to the datasets of this run."""
    live = current_rules(rules, status)
    if dataset_ids is not None:
        live = live.where(F.col("dataset_id").isin(list(dataset_ids)))
    grouped: dict[str, list] = {}
    for row in live.orderBy("dataset_id", "ordinal").toLocalIterator():
        grouped.setdefault(row["dataset_id"], []).append(row)
    found = {}
    for dataset_id, rows in grouped.items():
        found[dataset_id] = RuleSet(
            dataset_id=dataset_id,
            ruleset_version=rows[0]["ruleset_version"],
            owner_team=rows[0]["owner_team"],
            data_owner=rows[0]["data_owner"],
            rules=tuple(
                Rule.of({**r.asDict(), "expectation": json.loads(r["expectation"] or "{}")})
                for r in rows
            ),
        )
    return found
