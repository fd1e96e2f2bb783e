"""Rule proposals: heuristics over the profile, catalog baselines, templates, and
proposals that arrive as JSON."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.values import SPACE, text_literal
from plumbline.model import PROPOSALS_SCHEMA, RULE_TYPES
from plumbline.operators.candidates import CANDIDATE_TYPES, CandidateLimits, column_candidates

# What the heuristics propose and how sure they are.
DOMAIN_CONFIDENCE = "0.7"
DATE_CONFIDENCE = "0.6"
RANGE_CONFIDENCE = "0.6"
MAX_LISTED_VALUES = 20
DATE_RATIONALE = "Column name/dtype suggests datetime; prevent future dates."
MAX_RULES_TO_ADD = 15


def propose_rules(
    profile: DataFrame,
    allowed_rule_types: tuple[str, ...] = RULE_TYPES,
    limits: CandidateLimits = CandidateLimits(),
    max_rules_to_add: int = MAX_RULES_TO_ADD,
) -> DataFrame:
    """Heuristic proposals per dataset: domains, then dates, then non-negative ranges.

    A domain is proposed only when the profile lists all of its values.
    """
    wanted = tuple(t for t in CANDIDATE_TYPES if t in allowed_rule_types)
    found = column_candidates(profile, wanted, limits).selectExpr(
        "*",
        """case rule_type when 'domain' then 1 when 'date_not_in_future' then 2
                          when 'range' then 3 end as section""",
    )
    kept = found.where(
        f"""(rule_type = 'domain' and size(top_values) between 1 and {MAX_LISTED_VALUES}
             and distinct_count <= size(top_values))
            or rule_type = 'date_not_in_future'
            or (rule_type = 'range' and min < 0)"""
    )
    order = Window.partitionBy("dataset_id").orderBy("section", "rank")
    capped = kept.withColumn("ordinal", F.row_number().over(order).cast("bigint")).where(
        F.col("ordinal") <= max_rules_to_add
    )
    listed = "transform(slice(top_values, 1, 5), v -> concat('[', v.value, ', ', v.count, ']'))"
    return as_proposals(
        capped.selectExpr(
            "dataset_id",
            "ordinal",
            "rule_type",
            "column",
            "if(rule_type = 'range', 'low', 'medium') as severity",
            """case rule_type
                 when 'domain' then to_json(struct(top_values.value as allowed_values))
                 when 'range' then '{"min":0}' else '{}' end as params""",
            f"""case rule_type when 'domain' then '{DOMAIN_CONFIDENCE}'
                 when 'range' then '{RANGE_CONFIDENCE}' else '{DATE_CONFIDENCE}' end as confidence""",
            f"""case rule_type
                 when 'domain' then format_string(
                   'Low cardinality column with %d distinct values.', size(top_values))
                 when 'range' then format_string(
                   'Observed min=%s; suggest non-negative constraint.', cast(min as string))
                 else '{DATE_RATIONALE}' end as rationale""",
            f"""to_json(case rule_type
                 when 'domain' then array(concat('top_values=[', array_join({listed}, ', '), ']'))
                 when 'range' then array(concat('min=', min), concat('max=', max))
                 else array(concat('dtype=', dtype)) end) as evidence_used""",
        )
    )


def parse_proposals(raw: DataFrame) -> DataFrame:
    """Proposals from (dataset_id, ordinal, raw), one JSON value per row, in either shape.

    A value that is no object is kept as ``malformed``, so that it can be rejected by name.
    """
    parsed = raw.selectExpr("dataset_id", "cast(ordinal as bigint) as ordinal", "raw",
                            "try_parse_json(raw) as v")

    def text(name: str) -> str:
        return f"if(schema_of_variant(variant_get(v, '$.{name}', 'variant')) = 'STRING', " \
               f"variant_get(v, '$.{name}', 'string'), null)"

    def part(name: str) -> str:
        return f"to_json(variant_get(v, '$.{name}', 'variant'))"

    is_object = "coalesce(schema_of_variant(v) like 'OBJECT%', false)"
    fields = {
        "rule_type": f"coalesce({text('rule_type')}, {text('type')})",
        "column": text("column"),
        "columns": """transform(filter(try_variant_get(v, '$.columns', 'array<variant>'),
                      e -> schema_of_variant(e) = 'STRING'), e -> cast(e as string))""",
        "severity": text("severity"),
        "params": part("params"),
        "expectation": part("expectation"),
        "confidence": "try_variant_get(v, '$.confidence', 'string')",
        "rationale": text("rationale"),
        "evidence_used": part("evidence_used"),
        "description": text("description"),
        "rule_id": text("rule_id"),
    }
    guarded = [f"if({is_object}, {expr}, null) as {name}" for name, expr in fields.items()]
    return parsed.selectExpr("dataset_id", "ordinal", *guarded, f"not {is_object} as malformed")


def as_proposals(df: DataFrame) -> DataFrame:
    """Add the proposal columns that are not there, and put them in order."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name).cast(f.dataType)
            if f.name in have
            else F.lit(False if f.name == "malformed" else None).cast(f.dataType).alias(f.name)
            for f in PROPOSALS_SCHEMA.fields
        ]
    )


# Ids and texts of the rules that follow from the catalog.
BASELINE_AUTHOR = "dataset_config"
SCHEMA_RULE_ID = "schema_0001"
FRESHNESS_RULE_ID = "freshness_0001"
SCHEMA_TEXT = "Deterministic schema: required columns from dataset config"


def baseline_rules(
    catalog: DataFrame, rules: DataFrame, default_ts_column: str | None = None
) -> DataFrame:
    """Schema and freshness rules the catalog implies and the rule sets do not have yet.

    Columns of the result are those of the rules table that are known here; version and
    position come with the merge.
    """
    fallback = "null" if default_ts_column is None else text_literal(default_ts_column)
    entries = catalog.selectExpr(
        "*",
        f"nullif(btrim(ts_load_column, {SPACE}), '') as ts_column",
        f"nullif(btrim(coalesce(nullif(ts_load_column, ''), {fallback}), {SPACE}), '') as any_ts",
        "try_cast(freshness_max_age_days as int) as max_age_days",
    ).selectExpr(
        "*",
        """if(size(required_columns) > 0, required_columns,
              if(any_ts is not null, array(any_ts), null)) as required""",
    )
    implied = entries.selectExpr(
        "dataset_id",
        "owner_team",
        "data_owner",
        f"""inline(array_compact(array(
             if(required is not null, struct(
               1L as ordinal, '{SCHEMA_RULE_ID}' as rule_id, 'schema' as rule_type,
               'high' as severity, to_json(struct(required as required_columns)) as expectation,
               '{SCHEMA_TEXT}' as description), null),
             if(ts_column is not null and max_age_days is not null, struct(
               2L as ordinal, '{FRESHNESS_RULE_ID}' as rule_id, 'freshness' as rule_type,
               coalesce(freshness_severity, 'medium') as severity,
               to_json(struct(ts_column, max_age_days)) as expectation,
               format_string('Deterministic freshness: %d days max age', max_age_days)
                 as description), null))))""",
    )
    held = rules.select("dataset_id", "rule_type").distinct()
    return implied.join(held, ["dataset_id", "rule_type"], "left_anti").withColumn(
        "suggested_by", F.lit(BASELINE_AUTHOR)
    )


@dataclass(frozen=True)
class Template:
    """Which columns of a dataset play which part in the baseline rule template."""

    dataset_id: str
    prefix: str
    required_columns: tuple[str, ...] = ()
    key_column: str | None = None
    not_null: Mapping[str, str] = field(default_factory=dict)
    domain_column: str | None = None
    domain_max_length: int = 12
    range_column: str | None = None
    range_cap: bool = False
    date_column: str | None = None
    ts_column: str | None = None
    max_age_days: int | None = None


# Fixed values of the template: how far above the observed maximum a range ends, and
# how many values a domain lists.
RANGE_HEADROOM = 1.2
DOMAIN_VALUES = 10


def template_rules(
    spark: SparkSession, profile: DataFrame, templates: Iterable[Template]
) -> DataFrame:
    """Rules of the template, with domains and ranges taken from the profile.

    The template rows are configuration; what they need from the profile is joined to them.
    """
    rows = []
    for t in templates:
        slots: list[tuple] = []
        if t.required_columns:
            slots.append((f"{t.prefix}001_schema_presence", "schema", "critical", None))
        if t.key_column:
            slots.append((f"{t.prefix}002_{t.key_column}_unique", "uniqueness", "critical", t.key_column))
        for column, severity in t.not_null.items():
            slots.append((f"{t.prefix}003_{column}_not_null", "completeness", severity, column))
        if t.domain_column:
            slots.append((f"{t.prefix}010_{t.domain_column}_domain", "domain", "high", t.domain_column))
        if t.range_column:
            slots.append((f"{t.prefix}011_{t.range_column}_range", "range", "high", t.range_column))
        if t.date_column:
            slots.append(
                (f"{t.prefix}012_{t.date_column}_not_future", "date_not_in_future", "medium", t.date_column)
            )
        if t.ts_column:
            slots.append((f"{t.prefix}003_dataset_is_fresh", "freshness", "critical", t.ts_column))
        for ordinal, slot in enumerate(slots, start=1):
            rows.append(
                (
                    t.dataset_id, ordinal, *slot, list(t.required_columns),
                    t.domain_max_length, t.range_cap, t.max_age_days,
                )
            )
    layout = (
        "dataset_id string, ordinal bigint, rule_id string, rule_type string, severity string,"
        "column string, required_columns array<string>, max_length int, capped boolean,"
        "max_age_days int"
    )
    slots = spark.createDataFrame(rows, layout)
    seen = profile.select("dataset_id", "column", "top_values", "min", "max", "dtype")
    joined = slots.join(seen, ["dataset_id", "column"], "left")
    return joined.where("rule_type <> 'range' or not capped or max is not null").selectExpr(
        "dataset_id",
        "ordinal",
        "rule_id",
        "rule_type",
        "severity",
        f"""case rule_type
             when 'schema' then to_json(struct(required_columns))
             when 'uniqueness' then to_json(struct(column, 0 as max_duplicates_allowed))
             when 'completeness' then to_json(struct(column, 0 as max_null_percent))
             when 'domain' then to_json(struct(column, slice(transform(filter(
                 if(dtype = 'object', coalesce(top_values, array()), array()),
                 v -> length(btrim(v.value, {SPACE})) between 1 and max_length), v -> v.value),
                 1, {DOMAIN_VALUES}) as allowed_values))
             when 'range' then to_json(struct(column, 0 as min,
                 if(capped, bround(max * {RANGE_HEADROOM}D, 2), null) as max))
             when 'freshness' then to_json(struct(column, max_age_days, 'UTC' as timezone))
             else to_json(struct(column)) end as expectation""",
    )
