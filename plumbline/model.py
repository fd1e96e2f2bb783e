"""Rules, rule sets and the table layouts shared by the operators."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any

from pyspark.sql import types as T

# The rule types, and the prefix each one gives to generated rule ids.
RULE_PREFIXES = {
    "schema": "G",
    "completeness": "C",
    "uniqueness": "U",
    "domain": "D",
    "range": "R",
    "date_not_in_future": "T",
    "freshness": "F",
    "referential_integrity": "K",
}
DEFAULT_PREFIX = "R"
RULE_TYPES = tuple(RULE_PREFIXES)

# Rule types about one named column, and those whose bad rows are sampled.
SINGLE_COLUMN_TYPES = ("completeness", "uniqueness", "domain", "range", "date_not_in_future")
SAMPLED_TYPES = (*SINGLE_COLUMN_TYPES, "referential_integrity")

# Caps of the result payloads and of the bad-row samples.
TOP_KEYS = 20
TOP_VALUES = 10
MAX_SAMPLES = 100
SAMPLE_COLUMNS = 10


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_type: str
    severity: str = "medium"
    expectation: dict[str, Any] = field(default_factory=dict)
    suggested_by: str = "manual"
    description: str | None = None
    ai_confidence: float | None = None
    ai_rationale: str | None = None
    ai_evidence_used: Any = None

    @classmethod
    def of(cls, doc: Mapping[str, Any]) -> Rule:
        """Build a rule from a mapping, ignoring keys that are not rule fields."""
        known = {name: doc[name] for name in cls.__dataclass_fields__ if doc.get(name) is not None}
        return cls(**known)


@dataclass(frozen=True)
class RuleSet:
    dataset_id: str
    ruleset_version: int = 1
    rules: tuple[Rule, ...] = ()
    owner_team: str | None = None
    data_owner: str | None = None

    @classmethod
    def of(cls, doc: Mapping[str, Any]) -> RuleSet:
        return cls(
            dataset_id=doc["dataset_id"],
            ruleset_version=int(doc.get("ruleset_version", 1)),
            rules=tuple(Rule.of(r) for r in doc.get("rules") or ()),
            owner_team=doc.get("owner_team"),
            data_owner=doc.get("data_owner"),
        )


def value_text(value: Any) -> str:
    """A configured value as the text it is compared with."""
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def json_text(value: Any) -> str:
    """JSON for driver-side payloads; values JSON does not know become text."""
    return json.dumps(value, ensure_ascii=False, default=value_text)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

RULES_SCHEMA = _struct(
    ("dataset_id", _S),
    ("ruleset_version", _I),
    ("status", _S),
    ("owner_team", _S),
    ("data_owner", _S),
    ("ordinal", _L),
    ("rule_id", _S),
    ("rule_type", _S),
    ("severity", _S),
    ("expectation", _S),
    ("suggested_by", _S),
    ("description", _S),
    ("ai_confidence", _D),
    ("ai_rationale", _S),
    ("ai_evidence_used", _S),
)

# The columns of a result row, in their order.
RESULT_COLUMNS = (
    "run_id",
    "dataset_id",
    "ruleset_version",
    "rule_id",
    "rule_type",
    "severity",
    "status",
    "observed_value",
    "threshold",
    "sample_ref",
    "started_at",
    "finished_at",
    "execution_ms",
)

RESULTS_SCHEMA = _struct(
    *[(c, _S) for c in RESULT_COLUMNS if c not in ("ruleset_version", "execution_ms")],
    ("ruleset_version", _I),
    ("execution_ms", _L),
    ("seq", _I),
)

SAMPLES_SCHEMA = _struct(
    ("run_id", _S),
    ("dataset_id", _S),
    ("rule_id", _S),
    ("position", _I),
    ("payload", _S),
)

PROPOSALS_SCHEMA = _struct(
    ("dataset_id", _S),
    ("ordinal", _L),
    ("rule_type", _S),
    ("column", _S),
    ("columns", T.ArrayType(_S)),
    ("severity", _S),
    ("params", _S),
    ("expectation", _S),
    ("confidence", _S),
    ("rationale", _S),
    ("evidence_used", _S),
    ("description", _S),
    ("rule_id", _S),
    ("malformed", T.BooleanType()),
)

CATALOG_SCHEMA = _struct(
    ("dataset_id", _S),
    ("source_type", _S),
    ("source_location", _S),
    ("owner_team", _S),
    ("data_owner", _S),
    ("sla_tier", _S),
    ("required_columns", T.ArrayType(_S)),
    ("ts_load_column", _S),
    ("freshness_max_age_days", _S),
    ("freshness_severity", _S),
)


def rule_rows(rulesets: Iterable[RuleSet], status: str = "active") -> list[tuple]:
    """Rows of the rules table for rule sets held on the driver."""
    rows = []
    for rs in rulesets:
        for ordinal, r in enumerate(rs.rules, start=1):
            evidence = r.ai_evidence_used
            rows.append(
                (
                    rs.dataset_id,
                    rs.ruleset_version,
                    status,
                    rs.owner_team,
                    rs.data_owner,
                    ordinal,
                    r.rule_id,
                    r.rule_type,
                    r.severity,
                    json_text(r.expectation),
                    r.suggested_by,
                    r.description,
                    r.ai_confidence,
                    r.ai_rationale,
                    evidence if evidence is None or isinstance(evidence, str) else json_text(evidence),
                )
            )
    return rows
