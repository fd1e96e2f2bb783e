"""Adding accepted proposals to rule sets: shape, ids, versions, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.model import DEFAULT_PREFIX, RULE_PREFIXES, RULE_TYPES, RULES_SCHEMA, SINGLE_COLUMN_TYPES
from plumbline.operators.numbering import number_within
from plumbline.operators.proposals import as_proposals

# Who suggested a rule.
KEY_AUTHOR = "key_detection_engine"
PATCH_AUTHOR = "ai_patcher"


def _prefix() -> Column:
    pairs = [F.lit(x) for pair in RULE_PREFIXES.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col("rule_type"))
    return F.coalesce(found, F.lit(DEFAULT_PREFIX))


def _expectation() -> Column:
    """The expectation of a proposal in either shape, as JSON."""
    return F.expr(
        """case when schema_of_variant(try_parse_json(expectation)) like 'OBJECT%' then expectation
            else to_json(map_concat(
              map_filter(
                map('column', cast(coalesce(column, columns[0]) as variant)),
                (k, v) -> coalesce(column, try_element_at(columns, 1)) is not null
                  and not coalesce(map_contains_key(
                        from_json(params, 'map<string,variant>'), 'column'), false)),
              coalesce(from_json(params, 'map<string,variant>'), map()))) end"""
    )


def used_numbers(rules: DataFrame) -> DataFrame:
    """(dataset_id, prefix, n) of the ids that look like generated ones."""
    parts = rules.select(
        "dataset_id",
        "rule_id",
        F.regexp_extract("rule_id", r"^(\D+)(\d{3,9})$", 1).alias("prefix"),
        F.regexp_extract("rule_id", r"^(\D+)(\d{3,9})$", 2).try_cast("bigint").alias("n"),
    ).where((F.col("n") > 0) & (F.format_string("%s%03d", "prefix", "n") == F.col("rule_id")))
    return parts.select("dataset_id", "prefix", "n").distinct()


def allocate_ids(new: DataFrame, used: DataFrame) -> DataFrame:
    """Give every row of ``new`` (dataset_id, prefix, ordinal) the next free rule id.

    The k-th new rule of a prefix gets the k-th number that is not in use.  Among the
    first (new + used) numbers there are always enough free ones.
    """
    group = ["dataset_id", "prefix"]
    sizes = new.select(*group).unionByName(used.select(*group)).groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    numbers = sizes.select(*group, F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")).alias("n"))
    free = numbers.join(used, [*group, "n"], "left_anti")
    free = number_within(free, group, "n", "k").select(*group, "k", "n")
    placed = number_within(new, group, "ordinal", "k").join(free, [*group, "k"])
    return placed.withColumn("rule_id", F.format_string("%s%03d", "prefix", "n")).drop("k", "n")


def merge_rules(
    rules: DataFrame,
    to_add: DataFrame,
    suggested_by: str,
    default_severity: str = "medium",
) -> DataFrame:
    """The rules with the proposals appended as canonical rules.

    ``rules`` holds one version per dataset.  Proposals without a type are skipped; a
    proposal's own id is kept and reserved before any id is generated.
    """
    typed = as_proposals(to_add).where("length(rule_type) > 0")
    own = F.nullif(F.col("rule_id"), F.lit(""))
    shaped = typed.select(
        "dataset_id",
        "ordinal",
        own.alias("rule_id"),
        "rule_type",
        F.coalesce("severity", F.lit(default_severity)).alias("severity"),
        _expectation().alias("expectation"),
        F.nullif(F.col("description"), F.lit("")).alias("description"),
        F.col("confidence").try_cast("double").alias("ai_confidence"),
        F.col("rationale").alias("ai_rationale"),
        F.col("evidence_used").alias("ai_evidence_used"),
        _prefix().alias("prefix"),
    )
    named = shaped.where(F.col("rule_id").isNotNull())
    used = used_numbers(rules.select("dataset_id", "rule_id").unionByName(named.select("dataset_id", "rule_id")))
    generated = allocate_ids(shaped.where(F.col("rule_id").isNull()).drop("rule_id"), used)
    heads = rules.groupBy("dataset_id").agg(
        F.max("ordinal").alias("__end"),
        *[F.max(c).alias(c) for c in ("ruleset_version", "status", "owner_team", "data_owner")],
    )
    added = generated.unionByName(named).withColumn("suggested_by", F.lit(suggested_by))
    placed = number_within(added, ["dataset_id"], "ordinal", "__place").join(heads, "dataset_id", "left")
    placed = placed.withColumns(
        {
            "ordinal": F.coalesce("__end", F.lit(0)) + F.col("__place"),
            "ruleset_version": F.coalesce("ruleset_version", F.lit(1)),
        }
    )
    return rules.unionByName(as_rules(placed))


def as_rules(df: DataFrame) -> DataFrame:
    """Add the rule columns that are not there, and put them in order."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name).cast(f.dataType)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in RULES_SCHEMA.fields
        ]
    )


def next_versions(rules: DataFrame) -> DataFrame:
    """(dataset_id, next_version) of the datasets that have rules."""
    return rules.groupBy("dataset_id").agg((F.max("ruleset_version") + 1).alias("next_version"))


def stamp_version(merged: DataFrame, earlier: DataFrame, status: str = "suggested") -> DataFrame:
    """The merged rules as the next version after ``earlier``; version 1 for a new dataset."""
    stamped = merged.join(next_versions(earlier), "dataset_id", "left").withColumns(
        {
            "ruleset_version": F.coalesce("next_version", F.lit(1)),
            "status": F.lit(status),
        }
    )
    return as_rules(stamped)


def validate_rules(rules: DataFrame) -> DataFrame:
    """(dataset_id, rule_id, rule_type, problem) of the rules that are not well formed."""
    types = ", ".join(f"'{t}'" for t in RULE_TYPES)
    single = ", ".join(f"'{t}'" for t in SINGLE_COLUMN_TYPES)

    def filled_array(key: str) -> str:
        return f"coalesce(size(try_cast(__e['{key}'] as array<variant>)), 0) > 0"

    problem = f"""case
        when dataset_id is null then 'dataset_id is required'
        when ruleset_version is null then 'ruleset_version is required'
        when rule_id is null then 'rule_id is required'
        when rule_type is null then 'rule_type is required'
        when rule_type not in ({types}) then concat('unknown rule type: ', rule_type)
        when severity is null then 'severity is required'
        when __e is null then 'expectation must be an object'
        when rule_type in ({single}) and (
             not coalesce(schema_of_variant(__e['column']) = 'STRING', false)
             or length(trim(try_cast(__e['column'] as string))) = 0) then 'column is required'
        when rule_type = 'domain' and not {filled_array("allowed_values")}
          then 'allowed_values is required'
        when rule_type = 'range' and not map_contains_key(__e, 'min')
             and not map_contains_key(__e, 'max') then 'range must have min and/or max'
        when rule_type = 'schema' and not {filled_array("required_columns")}
          then 'required_columns is required' end"""
    object_only = """case when schema_of_variant(try_parse_json(expectation)) like 'OBJECT%'
                          then from_json(expectation, 'map<string,variant>') end"""
    return (
        rules.withColumn("__e", F.expr(object_only))
        .withColumn("problem", F.expr(problem))
        .where(F.col("problem").isNotNull())
        .select("dataset_id", "rule_id", "rule_type", "problem")
    )
