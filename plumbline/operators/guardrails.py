"""Which proposals may enter a rule set.

The checks of a single proposal are a ``case`` chain.  "First one wins" and the cap
on accepted rules are set operations: the smallest ordinal per signature, an anti-join
with the signatures already held, and a cut after the n-th accepted ordinal.  No
dataset's proposals are ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.model import RULE_TYPES, SINGLE_COLUMN_TYPES
from plumbline.operators.proposals import MAX_RULES_TO_ADD, as_proposals

# The keys of a payload that only name columns.
COLUMN_KEYS = ("column", "columns", "required_columns", "ts_column")

# The JSON texts that count as no parameters at all.
EMPTY_PARAMS = ("null", "{}", "[]", '""', "0", "false")

# The reasons of a rejection; the rejected value follows a colon.
NOT_A_DICT = "rule is not a dict"
TYPE_NOT_ALLOWED = "type not allowed: "
LOW_CONFIDENCE = "confidence below threshold: "
SEVERAL_COLUMNS = "only single column supported in patch format"
NO_COLUMN = "missing/invalid column"
UNKNOWN_COLUMN = "column not in dataset: "
PARAMS_NOT_DICT = "params must be dict"
DOMAIN_PARAMS = "domain.params must include allowed_values (preferred)"
RANGE_PARAMS = "range.params must include min and/or max"
DUPLICATE = "duplicate rule (signature already exists)"


def _listed(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def with_signature(rules: DataFrame) -> DataFrame:
    """Add ``signature``: the same for rules of one type, columns and parameters.

    Takes proposals or rules.  Key order in the parameters and the order of
    ``allowed_values`` do not matter, nor do severity and confidence.
    """
    have = set(rules.columns)
    params = "params" if "params" in have else "cast(null as string)"
    column = "column" if "column" in have else "cast(null as string)"
    columns = "columns" if "columns" in have else "cast(null as array<string>)"
    payload = f"case when {params} is null or {params} = 'null' then expectation else {params} end"
    entry = """concat(k, '=', if(
        k = 'allowed_values' and try_cast(__payload[k] as array<variant>) is not null,
        to_json(array_sort(transform(try_cast(__payload[k] as array<variant>), e -> to_json(e)))),
        to_json(__payload[k])))"""
    parsed = rules.withColumns(
        {
            "__expectation": F.expr("from_json(expectation, 'map<string,variant>')"),
            "__payload": F.expr(
                f"""map_filter(coalesce(from_json({payload}, 'map<string,variant>'), map()),
                               (k, v) -> k not in ({_listed(COLUMN_KEYS)}))"""
            ),
        }
    )
    named = f"""case
        when length(trim({column})) > 0 then array({column})
        when size({columns}) > 0 then {columns}
        when rule_type = 'schema' then coalesce(
          try_cast(__expectation['required_columns'] as array<string>), array())
        when rule_type = 'freshness' then array_compact(array(
          try_cast(__expectation['ts_column'] as string)))
        else array_compact(array(try_cast(__expectation['column'] as string))) end"""
    content = f"""array_join(transform(array_sort(map_keys(__payload)), k -> {entry}), ';')"""
    signature = f"""sha2(concat_ws('|', coalesce(rule_type, ''),
        to_json(array_sort({named})), {content}), 256)"""
    return parsed.withColumn("signature", F.expr(signature)).drop("__expectation", "__payload")


def _with_reason(
    proposals: DataFrame,
    allowed_rule_types: Iterable[str],
    dataset_columns: DataFrame,
    min_confidence: float | None,
) -> DataFrame:
    """Settle the column of each proposal and add the first reason to reject it, if any."""
    several = F.size(F.coalesce("columns", F.array())) > 0
    filled = F.expr(f"filter(columns, c -> not {V.is_blank('c', T.StringType())})")
    single = F.col("rule_type").isin(list(SINGLE_COLUMN_TYPES))
    ready = proposals.withColumn("__named", F.when(several, F.size(filled)).otherwise(0)).withColumn(
        "column",
        F.when(single & F.col("column").isNull() & (F.col("__named") == 1), filled[0]).otherwise(
            F.col("column")
        ),
    )
    known = dataset_columns.select("dataset_id", "column").distinct()
    joined = ready.join(known.withColumn("__known", F.lit(True)), ["dataset_id", "column"], "left")
    types = _listed(allowed_rule_types) or "null"
    low = "false"
    if min_confidence is not None:
        low = f"coalesce(try_cast(confidence as double) < {min_confidence}D, true)"
    no_params = f"(params is null or params in ({_listed(EMPTY_PARAMS)}))"
    is_map = "coalesce(schema_of_variant(try_parse_json(params)) like 'OBJECT%', false)"
    has = "coalesce(map_contains_key(from_json(params, 'map<string,variant>'), '{0}'), false)"
    reason = f"""case
        when malformed then '{NOT_A_DICT}'
        when not coalesce(rule_type in ({types}), false)
          then concat('{TYPE_NOT_ALLOWED}', coalesce(rule_type, 'None'))
        when {low} then concat('{LOW_CONFIDENCE}', coalesce(confidence, 'None'))
        when rule_type in ({_listed(SINGLE_COLUMN_TYPES)}) and column is null and __named > 1
          then '{SEVERAL_COLUMNS}'
        when rule_type in ({_listed(SINGLE_COLUMN_TYPES)})
             and (column is null or length(trim(column)) = 0) then '{NO_COLUMN}'
        when rule_type in ({_listed(SINGLE_COLUMN_TYPES)}) and __known is null
          then concat('{UNKNOWN_COLUMN}', column)
        when not {no_params} and not {is_map} then '{PARAMS_NOT_DICT}'
        when rule_type = 'domain' and not {has.format("allowed_values")}
             and not {has.format("max_distinct")} then '{DOMAIN_PARAMS}'
        when rule_type = 'range' and not {has.format("min")} and not {has.format("max")}
          then '{RANGE_PARAMS}' end"""
    return joined.withColumn("reject_reason", F.expr(reason)).drop("__named", "__known")




def judge_proposals(
    proposals: DataFrame,
    dataset_columns: DataFrame,
    existing_rules: DataFrame,
    allowed_rule_types: Iterable[str] = RULE_TYPES,
    max_rules_to_add: int = MAX_RULES_TO_ADD,
    min_confidence: float | None = None,
) -> DataFrame:
    """The proposals with ``decision`` (accepted / rejected) and ``reject_reason``.

    ``dataset_columns`` is (dataset_id, column).  Proposals after the one that fills the
    cap of their dataset are not judged and not returned; a cap below one acts as one.
    """
    cap = max(1, max_rules_to_add)
    judged = with_signature(
        _with_reason(as_proposals(proposals), tuple(allowed_rule_types), dataset_columns, min_confidence)
    )
    held = with_signature(existing_rules).select("dataset_id", "signature").distinct()
    fresh = (
        judged.where(F.col("reject_reason").isNull())
        .groupBy("dataset_id", "signature")
        .agg(F.min("ordinal").alias("ordinal"))
        .join(held, ["dataset_id", "signature"], "left_anti")
    )
    order = Window.partitionBy("dataset_id").orderBy("ordinal")
    taken = fresh.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
    chosen = taken.select("dataset_id", "ordinal", F.lit(True).alias("__chosen"))
    last = taken.where(F.col("place") == cap).select("dataset_id", F.col("ordinal").alias("__last"))
    decided = (
        judged.join(chosen, ["dataset_id", "ordinal"], "left")
        .join(last, "dataset_id", "left")
        .where(F.col("__last").isNull() | (F.col("ordinal") <= F.col("__last")))
    )
    accepted = F.col("__chosen").isNotNull()
    reason = F.when(~accepted, F.coalesce("reject_reason", F.lit(DUPLICATE)))
    return decided.withColumns(
        {
            "decision": F.when(accepted, F.lit("accepted")).otherwise(F.lit("rejected")),
            "reject_reason": reason,
        }
    ).drop("__chosen", "__last", "signature")


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Accepted and rejected proposals per dataset."""
    return decisions.groupBy("dataset_id").agg(
        F.count_if(F.col("decision") == "accepted").alias("accepted"),
        F.count_if(F.col("decision") == "rejected").alias("rejected"),
    )
