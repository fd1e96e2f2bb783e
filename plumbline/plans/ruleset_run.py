"""Running rule sets: one shared scan per dataset, value counts where needed.

``measure`` plans all rules of all given rule sets as one DataFrame with a row
per rule.  Row-local rules of a dataset share a single aggregate; uniqueness
rules share one count per column; invalid values of all domain rules share one
count; keys and the keys of their parents meet in one count, shared by the rules
on them.  ``results`` gives the result rows, ``violations`` and ``sample`` the bad
rows, and ``execute`` runs it all and writes it.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cache
from time import monotonic
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    PySparkException,
    SparkRuntimeException,
    UnsupportedOperationException,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.functions.scalars import utc_text
from plumbline.model import (
    MAX_SAMPLES,
    RESULT_COLUMNS,
    RESULTS_SCHEMA,
    SAMPLE_COLUMNS,
    SAMPLED_TYPES,
    TOP_KEYS,
    TOP_VALUES,
    RuleSet,
    json_text,
)
from plumbline.operators import value_counts as C
from plumbline.operators.checks import Check, Clock, Grouping, compile_rule
from plumbline.session import settle
from plumbline.sources.sinks import append_results, append_samples, begin_run, sample_folder

# Aggregates per scan; more rules than this are measured in several scans, to keep
# generated code compilable.
CHECKS_PER_SCAN = 100
# Counts that one shuffled key carries for the rules that share it.
COUNTS_PER_KEY = 8
# Rules that ``execute`` measures in one job; it runs as many jobs as it takes.
RULES_PER_JOB = 300

# Share of the bad rows in which a bound for the first ones is looked for; of rules about
# values, whose rows are bad by their key, it is a share of the keys.
BOUND_SHARE = 1 / 256
KEY_SHARES = 256

# What a rule's expressions can raise.  Anything else, such as a lost executor or a
# cancelled job, says nothing about the data and ends the run.
EVALUATION_ERRORS = (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    SparkRuntimeException,
    UnsupportedOperationException,
)

Datasets = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Planned:
    """The compiled rules of one rule set."""

    ruleset: RuleSet
    checks: tuple[Check, ...]


def plan(rulesets: Iterable[RuleSet], datasets: Datasets, clock: Clock) -> list[Planned]:
    """Compile the rules; ``seq`` numbers them through the whole run, in order."""
    planned, seq = [], 0
    for ruleset in rulesets:
        checks = []
        for rule in ruleset.rules:
            checks.append(compile_rule(seq, rule, ruleset.dataset_id, datasets, clock))
            seq += 1
        planned.append(Planned(ruleset, tuple(checks)))
    return planned


# What is known of a rule before its data is seen.
DESCRIPTION = (
    "struct<seq:int,branch:int,dataset_id:string,ruleset_version:int,rule_id:string,"
    "rule_type:string,severity:string,threshold:string,allowance:double,given_status:string,"
    "given_observed:string,if_empty:string>"
)


def _description(ruleset: RuleSet, check: Check, branch: int | None) -> dict[str, Any]:
    status, observed = check.verdict or (None, None)
    return {
        "seq": check.seq,
        "branch": branch,
        "dataset_id": ruleset.dataset_id,
        "ruleset_version": ruleset.ruleset_version,
        "rule_id": check.rule.rule_id,
        "rule_type": check.rule.rule_type,
        "severity": check.rule.severity,
        "threshold": json_text(check.threshold),
        "allowance": check.allowance,
        "given_status": status,
        "given_observed": None if observed is None else json_text(observed),
        "if_empty": None if check.if_empty is None else json_text(check.if_empty),
    }


def _scan_rows(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """One pass over a dataset for all its checks: (at, total, failed, latest) per check."""
    aggregates = ["count(1) as total"]
    rows = []
    for at, check in checks:
        failed = latest = "cast(null as bigint)"
        if check.bad is not None:
            failed = f"failed_{at}"
            aggregates.append(f"count_if({check.bad}) as {failed}")
        if check.latest is not None:
            latest = f"latest_{at}"
            aggregates.append(f"{check.latest} as {latest}")
        rows.append(f"struct({at} as at, total, {failed} as failed, {latest} as latest)")
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


def _branches(planned: list[Planned]) -> dict[tuple, int]:
    """A number for every distinct grouping; equal groupings share one count."""
    numbers: dict[tuple, int] = {}
    for p in planned:
        for check in p.checks:
            if check.grouping is not None:
                numbers.setdefault(_branch_key(check), len(numbers))
    return numbers


def _branch_key(check: Check) -> tuple:
    own = check.seq if check.grouping.kind == "invalid" else None
    return (check.dataset, check.grouping, own)


def keys_of(grouping: Grouping, df: DataFrame, datasets: Datasets) -> tuple[DataFrame, str, Any]:
    """The (key, n) frame of a grouping, the matching key of a row of ``df``, its type."""
    column, kind = V.named(grouping.column), C.kind_of(df, grouping.column)
    if grouping.kind == "repeated":
        repeated = C.repeated_keys_by_hash if grouping.by_hash else C.repeated_keys
        return repeated(df, grouping.column), V.groupable(column, kind), V.key_type(kind)
    parent = datasets[grouping.parent_dataset]
    parent_kind = C.kind_of(parent, grouping.parent_column)
    key, key_kind, _ = V.same_footing(column, kind, V.named(grouping.parent_column), parent_kind)
    keys = C.orphan_keys(df, grouping.column, parent, grouping.parent_column)
    return keys, key, key_kind


def _ends(dataset: str, grouping: Grouping, datasets: Datasets) -> tuple[list[tuple[str, str, str]], T.DataType]:
    """(dataset, key, predicate of the rows to count) of what a grouping counts, the parent last, and the key's type."""
    kind = C.kind_of(datasets[dataset], grouping.column)
    column = V.named(grouping.column)
    if grouping.kind == "repeated":
        return [(dataset, V.groupable(column, kind), "true")], V.key_type(kind)
    parent_kind = C.kind_of(datasets[grouping.parent_dataset], grouping.parent_column)
    key, key_kind, parent_key = V.same_footing(column, kind, V.named(grouping.parent_column), parent_kind)
    child = (dataset, key, f"not {V.is_blank(column, kind)}")
    return [child, (grouping.parent_dataset, parent_key, "true")], key_kind


def _families(groupings: dict[int, tuple[str, Grouping]], datasets: Datasets) -> list[dict[int, tuple]]:
    """The branches by what they count: those with a dataset and key in common are one family.

    Every key of a family carries all its counts, so a family has ``COUNTS_PER_KEY`` at most.
    """
    families: list[dict[int, tuple]] = []

    def ends_of(family: dict[int, tuple]) -> set[tuple[str, str, str]]:
        return {end for *_, ends, _ in family.values() for end in ends}

    def keys_met(family: dict[int, tuple]) -> set[tuple[str, str, str]]:
        return {(*end[:2], kind.simpleString()) for _, g, ends, kind in family.values() if not g.by_hash for end in ends}

    for branch, (dataset, grouping) in groupings.items():
        family = {branch: (dataset, grouping, *_ends(dataset, grouping, datasets))}
        keys, apart = keys_met(family), []
        for other in families:
            if keys.isdisjoint(keys_met(other)) or len(ends_of(other | family)) > COUNTS_PER_KEY:
                apart.append(other)
            else:
                family = other | family
        families = [*apart, family]
    return families


def _family_counts(family: dict[int, tuple], datasets: Datasets) -> DataFrame:
    """(branch, value, n) of the groupings of a family: every dataset's keys are shuffled once for all of them."""
    names: dict[tuple[str, str, str], str] = {}
    branches = {}
    for branch, (dataset, grouping, ends, kind) in family.items():
        if grouping.kind == "repeated" and len(family) == 1:
            return C.key_texts(keys_of(grouping, datasets[dataset], datasets)[0], branch, kind)
        own, *parent = [names.setdefault(end, f"n{len(names)}") for end in ends]
        # a null key equals no key of the parent
        wanted = f"{own} > 0 and (key is null or {parent[0]} = 0)" if parent else f"{own} > 1"
        branches[branch] = (wanted, own)
    sides: dict[tuple[str, str], dict[str, str]] = {}
    for (dataset, key, predicate), name in names.items():
        sides.setdefault((dataset, key), {})[name] = predicate
    return C.met_counts([(datasets[d], key, counted) for (d, key), counted in sides.items()], branches, kind)


def _counted(planned: list[Planned], datasets: Datasets, branches: dict[tuple, int]) -> DataFrame | None:
    """(branch, totals, top values) of every grouping, or None if there is none."""
    groupings: dict[int, tuple[str, Grouping]] = {}
    invalid: dict[str, dict[int, tuple[str, str]]] = {}
    columns: dict[str, dict[int, str]] = {}
    for p in planned:
        for check in p.checks:
            if check.grouping is None:
                continue
            branch = branches[_branch_key(check)]
            columns.setdefault(check.dataset, {})[branch] = check.grouping.column
            if check.grouping.kind == "invalid":
                tests = invalid.setdefault(check.dataset, {})
                tests[branch] = (check.grouping.column, check.bad)
            else:
                groupings[branch] = (check.dataset, check.grouping)
    parts = [_family_counts(family, datasets) for family in _families(groupings, datasets)]
    for dataset, tests in invalid.items():
        parts.append(C.invalid_values(datasets[dataset], tests))
    if not parts:
        return None
    counted = C.union_all(parts)
    sources = [(datasets[d], named) for d, named in columns.items()]
    if len(branches) == 1:  # ordered top rows, which are not sorted
        return C.totals(counted).join(C.top_values(counted, TOP_KEYS, sources), "branch", "left")
    leveled = C.levels(counted)
    best = C.top_rows_by_level(counted, leveled, max(TOP_KEYS, C.TIED))
    return C.totals_of_levels(leveled).join(C.top_values(counted, TOP_KEYS, sources, best), "branch", "left")


def measure(
    spark: SparkSession,
    rulesets: Iterable[RuleSet],
    datasets: Datasets,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per rule with typed measures, status and payloads (lazy)."""
    clock = Clock.at(as_of)
    return _measure(spark, plan(rulesets, datasets, clock), datasets, clock)


def _measure(
    spark: SparkSession, planned: list[Planned], datasets: Datasets, clock: Clock
) -> DataFrame:
    branches = _branches(planned)
    described: list[dict[str, Any]] = []
    ready: list[int] = []
    by_dataset: dict[str, list[tuple[int, Check]]] = {}
    for p in planned:
        for check in p.checks:
            at, branch = len(described), None
            if check.verdict is not None:
                ready.append(at)
            else:
                branch = branches[_branch_key(check)] if check.grouping is not None else None
                by_dataset.setdefault(check.dataset, []).append((at, check))
            described.append(_description(p.ruleset, check, branch))
    parts = []
    for dataset, checks in by_dataset.items():
        for start in range(0, len(checks), CHECKS_PER_SCAN):
            parts.append(_scan_rows(datasets[dataset], checks[start : start + CHECKS_PER_SCAN]))
    if ready:
        none = "cast(null as bigint)"
        parts.append(
            spark.range(1).selectExpr(
                f"explode(array({', '.join(map(str, ready))})) as at",
                *[f"{none} as {c}" for c in ("total", "failed", "latest")],
            )
        )
    if not parts:
        raise ValueError("no rules to run")
    lookup = F.from_json(F.lit(json_text(described)), f"array<{DESCRIPTION}>")
    rows = C.union_all(parts).withColumn("rule", F.element_at(lookup, F.col("at") + 1))
    rows = rows.select("rule.*", "total", "failed", "latest")
    counted = _counted(planned, datasets, branches)
    if counted is None:
        counts = [f"cast(null as bigint) as {c}" for c in ("rows", "surplus", "keys")]
        rows = rows.selectExpr("*", *counts, f"cast(null as {TOP}) as top")
    else:
        rows = rows.join(counted, "branch", "left")
    return _judged(rows, clock)


TOP = "array<struct<value:string,n:bigint>>"


def _judged(rows: DataFrame, clock: Clock) -> DataFrame:
    """Status and payloads from the measures."""
    rows = rows.selectExpr(
        "* except (failed, top)",
        """case when given_status is not null then null
                when rule_type = 'uniqueness' then coalesce(surplus, 0L)
                when rule_type = 'referential_integrity' then coalesce(rows, 0L)
                else failed end as failed""",
        f"""case when rule_type in ('uniqueness', 'domain', 'referential_integrity')
                 then coalesce(top, cast(array() as {TOP})) end as top""",
        f"({clock.micros}L - latest) / 86400000000D as age",
    ).selectExpr(
        "*",
        """case when rule_type = 'completeness'
                then coalesce(failed / cast(nullif(total, 0) as double) * 100D, 0D) end as null_pct""",
        "bround(age, 4) as age_days",
        f"""if(rule_type in ('domain', 'referential_integrity'),
               map_from_entries(slice(top, 1, {TOP_VALUES})), null) as top_counts""",
        f"'{clock.today.isoformat()}' as today",
    )

    def payload_of(*fields: str) -> str:
        named = ", ".join(fields)
        return f"to_json(struct({named}), map('ignoreNullFields', 'false'))"

    rows = rows.selectExpr(
        "*",
        f"{utc_text('latest')} as max_ts_load_utc",
        f"{utc_text(f'{clock.micros}L')} as now_utc",
    )
    return rows.selectExpr(
        "seq",
        "dataset_id",
        "ruleset_version",
        "rule_id",
        "rule_type",
        "severity",
        """coalesce(given_status, case when
             case rule_type when 'completeness' then null_pct <= allowance
                            when 'uniqueness' then failed <= allowance
                            when 'freshness' then age <= allowance
                            else failed = 0 end
             then 'pass' else 'fail' end) as status""",
        "failed",
        "total",
        "null_pct",
        "age_days",
        "keys",
        "top",
        f"""case when given_observed is not null then given_observed
              when rule_type = 'completeness'
                then {payload_of("failed as null_count", "total", "null_pct")}
              when rule_type = 'uniqueness'
                then {payload_of("top.value as duplicate_keys", "failed as duplicates", "total")}
              when rule_type = 'domain'
                then {payload_of("failed", "total", "top_counts as top_invalid_values")}
              when rule_type = 'referential_integrity'
                then {payload_of("failed", "total", "top_counts as top_missing_parent_keys")}
              when rule_type = 'date_not_in_future'
                then {payload_of("failed", "total", "today")}
              when rule_type = 'freshness' and latest is null then if_empty
              when rule_type = 'freshness'
                then {payload_of("max_ts_load_utc", "now_utc", "age_days")}
              else {payload_of("failed", "total")} end as observed_value""",
        "threshold",
    )


def results(measured: DataFrame, run_id: str) -> DataFrame:
    """Result rows of a lazily planned run; times and samples belong to ``execute``."""
    none = F.lit(None)
    return measured.select(
        F.lit(run_id).alias("run_id"),
        "dataset_id",
        "ruleset_version",
        "rule_id",
        "rule_type",
        "severity",
        "status",
        "observed_value",
        "threshold",
        none.cast("string").alias("sample_ref"),
        none.cast("string").alias("started_at"),
        none.cast("string").alias("finished_at"),
        none.cast("bigint").alias("execution_ms"),
        "seq",
    )


def run_ruleset(
    spark: SparkSession,
    run_id: str,
    ruleset: RuleSet,
    datasets: Datasets,
    as_of: datetime | None = None,
) -> DataFrame:
    if not _runnable(ruleset, datasets):
        have = sorted(datasets)
        raise ValueError(f"Dataset '{ruleset.dataset_id}' not loaded. Available: {have}")
    return results(measure(spark, [ruleset], datasets, as_of), run_id)


def run_all(
    spark: SparkSession,
    run_id: str,
    rulesets: Iterable[RuleSet],
    datasets: Datasets,
    as_of: datetime | None = None,
) -> DataFrame:
    """All rule sets whose data is loaded, in dataset order, as one plan."""
    return results(measure(spark, select_rulesets(rulesets, datasets), datasets, as_of), run_id)


def select_rulesets(rulesets: Iterable[RuleSet], datasets: Datasets) -> list[RuleSet]:
    """The rule sets to run: in dataset order, then those that span datasets."""
    by_id = {rs.dataset_id: rs for rs in rulesets}
    chosen = [by_id[d] for d in datasets if d in by_id]
    chosen += [rs for d, rs in by_id.items() if d not in datasets and _runnable(rs, datasets)]
    unruled = [d for d in datasets if d not in by_id]
    unloaded = [d for d, rs in by_id.items() if d not in datasets and not _runnable(rs, datasets)]
    for what, names in (("datasets without a rule set", unruled), ("rule sets without their dataset", unloaded)):
        if names:
            warnings.warn(f"not run: {what}: {', '.join(sorted(names))}", stacklevel=2)
    if not chosen:
        raise ValueError("No results produced. Check datasets and rulesets.")
    return chosen


def _runnable(ruleset: RuleSet, datasets: Datasets) -> bool:
    """A rule set needs its dataset, unless every rule names its own child dataset."""
    return ruleset.dataset_id in datasets or (
        len(ruleset.rules) > 0
        and all(
            r.rule_type == "referential_integrity" and r.expectation.get("child_dataset")
            for r in ruleset.rules
        )
    )


def violations(check: Check, datasets: Datasets) -> DataFrame:
    """Every bad row of one row-level rule, with the dataset's own columns."""
    df = datasets[check.dataset]
    if check.bad is not None:
        return df.where(check.bad)
    if check.grouping is None:
        raise ValueError(f"rule type '{check.rule.rule_type}' has no bad rows")
    keys, key, _ = keys_of(check.grouping, df, datasets)
    return C.rows_with_keys(df, key, keys)


def sample(
    planned: Iterable[Planned],
    datasets: Datasets,
    only: Iterable[int] | None = None,
    order_by: Mapping[str, list[str]] | None = None,
    max_samples: int = MAX_SAMPLES,
) -> DataFrame | None:
    """(dataset_id, rule_id, position, payload): the first bad rows of each rule.

    ``only`` limits it to some ``seq``.  Rows are ordered by ``order_by`` of the
    dataset, by default its leading columns.  A rule by itself is planned as ordered top
    rows.  Several row-local rules of a dataset share their scans: one over a small
    share of the rows gives each rule a bound, and only bad rows up to it are ordered.
    For rules about values the bound is looked for now, in a share of their keys.
    """
    wanted = None if only is None else set(only)
    parts = []
    for p in planned:
        local: dict[str, list[Check]] = {}
        for check in p.checks:
            picked = wanted is None or check.seq in wanted
            if not picked or check.verdict is not None or check.rule.rule_type not in SAMPLED_TYPES:
                continue
            if check.bad is not None:
                local.setdefault(check.dataset, []).append(check)
            else:
                order = _order(datasets[check.dataset], check.dataset, order_by)
                rows = _first_violations(check, datasets, order, max_samples)
                tag = _tag(p.ruleset, check)
                parts.append(_first_rows(rows, tag, order, max_samples))
        for dataset, checks in local.items():
            df = datasets[dataset]
            if len(checks) == 1:
                (check,) = checks
                parts.append(_first_rows(df.where(check.bad), _tag(p.ruleset, check), _order(df, dataset, order_by), max_samples))
                continue
            tags = ", ".join(f"if({c.bad}, {_tag(p.ruleset, c)}, null)" for c in checks)
            tags = f"explode(array_compact(array({tags})))"
            parts.append(_first_rows(df, tags, _order(df, dataset, order_by), max_samples, bounded=True))
    return C.union_all(parts) if parts else None


def _first_violations(check: Check, datasets: Datasets, order: list[str], max_samples: int) -> DataFrame:
    """Bad rows of a rule about values, the first ``max_samples`` by ``order`` among them."""
    try:
        return _bounded_violations(check, datasets, order, max_samples)
    except (PySparkException, Py4JJavaError):  # what fails belongs to whoever reads the rows
        return violations(check, datasets)


def _bounded_violations(check: Check, datasets: Datasets, order: list[str], max_samples: int) -> DataFrame:
    """The same, without moving rows that cannot be among the first.

    Whether a row is bad depends on its key alone, so all is known about the keys of a
    share from the rows that have them.  The place of their ``max_samples``-th bad row is
    a bound; only rows up to it are looked at, and only keys of these are counted or
    looked for in the parent.  With fewer bad rows in the share there is no bound, but
    few bad keys.  Keys are picked by broadcast hashes as long as these are few, and
    what remains is decided by key.
    """
    df, grouping = datasets[check.dataset], check.grouping
    kinds = {f.name: f.dataType for f in df.schema.fields}
    column, kind = V.named(grouping.column), kinds[grouping.column]
    if grouping.kind == "repeated":
        key, parent_key = V.groupable(column, kind), None
    else:
        parent_kind = C.kind_of(datasets[grouping.parent_dataset], grouping.parent_column)
        key, _, parent_key = V.same_footing(column, kind, V.named(grouping.parent_column), parent_kind)

    def of_share(rows: DataFrame, key: str) -> DataFrame:
        return rows.where(f"pmod(xxhash64({key}), {KEY_SHARES}) = 0")

    def picked_by(hashes: DataFrame) -> Callable[[DataFrame, str], DataFrame]:
        return lambda rows, key: rows.join(F.broadcast(hashes), F.expr(f"xxhash64({key}) = `__hash`"), "left_semi")

    def bad_keys(rows: DataFrame, pick: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """The bad ones among the keys of ``rows``, which ``pick`` finds in the parent too."""
        parents = {} if parent_key is None else {grouping.parent_dataset: pick(datasets[grouping.parent_dataset], parent_key)}
        return keys_of(grouping, rows, {**datasets, **parents})[0]

    place = f"struct({', '.join(V.groupable(V.named(c), kinds[c]) for c in order)})"
    some = of_share(df, key)
    first = C.rows_with_keys(some, key, bad_keys(some, of_share)).selectExpr(f"{place} as `__bound`").orderBy("__bound").limit(max_samples)
    bound = settle(first.agg(F.max("__bound").alias("__bound"), F.expr("count(1) as `__n`")))
    if bound.select("__n").first()[0] < max_samples:
        keys = settle(keys_of(grouping, df, datasets)[0])
        if keys.count() <= C.BROADCAST_HASHES:
            df = picked_by(keys.selectExpr("xxhash64(key) as `__hash`"))(df, key)
        return C.rows_with_keys(df, key, keys)
    near = df.join(F.broadcast(bound.select("__bound")), F.expr(f"{place} <= `__bound`"), "left_semi")
    hashes = settle(near.selectExpr(f"xxhash64({key}) as `__hash`").distinct())
    if hashes.count() > C.BROADCAST_HASHES:
        return C.rows_with_keys(near, key, keys_of(grouping, df, datasets)[0])
    pick = picked_by(hashes)
    return C.rows_with_keys(near, key, settle(bad_keys(pick(df, key) if parent_key is None else near, pick)))


def _tag(ruleset: RuleSet, check: Check) -> str:
    dataset_id, rule_id = V.text_literal(ruleset.dataset_id), V.text_literal(check.rule.rule_id)
    return f"struct({check.seq} as seq, {dataset_id} as dataset_id, {rule_id} as rule_id)"


def _order(df: DataFrame, dataset: str, order_by: Mapping[str, list[str]] | None) -> list[str]:
    named = (order_by or {}).get(dataset)
    return list(named) if named else _sample_columns(df)


def _sample_columns(df: DataFrame) -> list[str]:
    return df.columns[:SAMPLE_COLUMNS]


def _first_rows(df: DataFrame, tags: str, order: list[str], max_samples: int, bounded: bool = False) -> DataFrame:
    """The first rows per tag.  With one constant tag Spark plans it as ordered top rows."""
    shown = _sample_columns(df)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    needed = list(dict.fromkeys([*shown, *order]))
    tagged = df.selectExpr(f"{tags} as `__tag`", *[V.named(c) for c in needed])
    if bounded:
        first = V.groupable(V.named(order[0]), kinds[order[0]])
        bounds = F.broadcast(_bounds(df.selectExpr(f"{tags} as `__tag`", f"{first} as `__key`"), max_samples))
        near = F.expr(f"`__unbounded` is null or {first} is null or {first} <= `__bound`")
        tagged = tagged.join(bounds, F.col("__tag.seq") == F.col("__seq"), "left").where(near)
    keys = ", ".join(V.groupable(V.named(c), kinds[c]) for c in order)
    place = f"row_number() over (partition by `__tag`.seq order by {keys})"
    ranked = tagged.withColumn("__place", F.expr(place)).where(F.col("__place") <= max_samples)
    fields = ", ".join(V.named(c) for c in shown)
    return ranked.selectExpr(
        "`__tag`.dataset_id as dataset_id",
        "`__tag`.rule_id as rule_id",
        "`__place` as position",
        f"to_json(struct({fields}), map('ignoreNullFields', 'false')) as payload",
    )


def _bounds(tagged: DataFrame, max_samples: int) -> DataFrame:
    """(__seq, __bound, __unbounded): per rule a key that ``max_samples`` of its bad rows do not exceed.

    The place of a row among some of the rows is no later than among all of them, so the
    key at that place in any part of the rows is a bound for all.  A rule with too few
    rows in the part has no bound, and few rows to order.  One row per rule.
    """
    some = tagged.where(f"rand(1) < {BOUND_SHARE}")
    ranked = some.withColumn("__place", F.expr("row_number() over (partition by `__tag`.seq order by `__key`)"))
    return ranked.where(F.col("__place") == max_samples).select(
        F.col("__tag.seq").alias("__seq"), F.col("__key").alias("__bound"), F.lit(False).alias("__unbounded")
    )


@dataclass(frozen=True)
class Run:
    """What ``execute`` leaves behind: the result rows and the bad-row samples."""

    run_id: str
    results: DataFrame
    samples: DataFrame | None


def new_run_id(now: datetime | None = None) -> str:
    """A run id that sorts by time: ``run_yyyymmdd_hhmmss`` in UTC."""
    return (now or datetime.now(timezone.utc)).strftime("run_%Y%m%d_%H%M%S")


def execute(
    spark: SparkSession,
    run_id: str | None,
    rulesets: Iterable[RuleSet],
    datasets: Datasets,
    results_dir: str | None = None,
    as_of: datetime | None = None,
    order_by: Mapping[str, list[str]] | None = None,
    max_samples: int = MAX_SAMPLES,
) -> Run:
    """Run the rules, sample the bad rows of failed rules, and write both.

    Only one small row per rule reaches the driver.  Should the data make a joint plan
    fail, its rules are run by halves, and a rule that fails alone becomes an error row;
    other faults end the run.  A rule whose rows cannot be sampled loses its own sample
    only.  A run id that is already there is replaced when results and samples are all
    written, and stays as it was if the run ends before; without an id a new one is made.
    """
    run_id = run_id or new_run_id()
    clock = Clock.at(as_of)
    planned = plan(select_rulesets(rulesets, datasets), datasets, clock)
    measured = [row for part in _jobs(planned) for row in _collect(spark, part, datasets, clock)]
    failing = [
        m["seq"]
        for m in measured
        if m["status"] == "fail" and m["rule_type"] in SAMPLED_TYPES and m["failed"]
    ]
    written = begin_run(spark, results_dir, run_id) if results_dir else None
    rows = []
    for m in sorted(measured, key=lambda m: m["seq"]):
        ref = None
        if written and m["seq"] in failing:
            ref = sample_folder(written, m["dataset_id"], m["rule_id"])
        rows.append({**m, "run_id": run_id, "sample_ref": ref})
    fields = [f.name for f in RESULTS_SCHEMA.fields]
    table = spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], RESULTS_SCHEMA)
    table = table.select(*RESULT_COLUMNS, "seq")

    @cache  # the rows that are written and those that are returned share their bounds
    def bad_rows(some: tuple[int, ...]) -> DataFrame:
        found = sample(planned, datasets, some, order_by, max_samples)
        return found.select(F.lit(run_id).alias("run_id"), "*")

    def write_samples(some: list[int]) -> None:
        try:
            append_samples(bad_rows(tuple(some)), written)
        except EVALUATION_ERRORS as problem:
            if len(some) == 1:
                warnings.warn(f"no sample of rule {some[0]}: {_condition(problem)}", stacklevel=2)
            for half in (some[: len(some) // 2], some[len(some) // 2 :]):
                if len(some) > 1:
                    write_samples(half)

    if written:
        append_results(table, written)
        if failing:
            write_samples(failing)
        written.commit()
    return Run(run_id, table, bad_rows(tuple(failing)) if failing else None)


def _jobs(planned: list[Planned]) -> list[list[Planned]]:
    """Rule sets that are measured together, so that no plan grows without bound."""
    parts: list[list[Planned]] = []
    room = 0
    for p in planned:
        if parts and len(p.checks) <= room:
            parts[-1].append(p)
            room -= len(p.checks)
            continue
        for start in range(0, len(p.checks), RULES_PER_JOB):
            some = p.checks[start : start + RULES_PER_JOB]
            parts.append([Planned(p.ruleset, some)])
            room = RULES_PER_JOB - len(some)
    return parts


def _collect(
    spark: SparkSession, planned: list[Planned], datasets: Datasets, clock: Clock
) -> list[dict[str, Any]]:
    """The measured rows of a run, with the time of the job that gave each of them."""
    wanted = (
        "seq", "dataset_id", "ruleset_version", "rule_id", "rule_type", "severity", "status",
        "failed", "keys", "observed_value", "threshold",
    )

    def timed(part: list[Planned]) -> list[dict[str, Any]]:
        started, clock_start = _utc_now(), monotonic()
        found = _measure(spark, part, datasets, clock).select(*wanted).collect()
        took = int((monotonic() - clock_start) * 1000)
        times = {"started_at": started, "finished_at": _utc_now(), "execution_ms": took}
        return [{**row.asDict(), **times} for row in found]

    try:
        return timed(planned)
    except EVALUATION_ERRORS as problem:
        single = [Planned(p.ruleset, (check,)) for p in planned for check in p.checks]
        # rules of one column side by side: what cannot be evaluated is mostly a column, and is cornered at once
        single.sort(key=lambda p: (p.checks[0].dataset, str(p.checks[0].rule.expectation.get("column"))))
        if len(single) > 1:
            middle = len(single) // 2
            halves = (single[:middle], single[middle:])
            return [row for half in halves for row in _collect(spark, half, datasets, clock)]
        (p,) = single
        return [_error_row(p.ruleset, p.checks[0], problem)]


def _condition(problem: Exception) -> str:
    """The stable name of what went wrong."""
    return getattr(problem, "getCondition", lambda: None)() or type(problem).__name__


def _error_row(ruleset: RuleSet, check: Check, problem: Exception) -> dict[str, Any]:
    now = _utc_now()
    return {
        "seq": check.seq,
        "dataset_id": ruleset.dataset_id,
        "ruleset_version": ruleset.ruleset_version,
        "rule_id": check.rule.rule_id,
        "rule_type": check.rule.rule_type,
        "severity": check.rule.severity,
        "status": "fail",
        "failed": None,
        "keys": None,
        "observed_value": json_text({"error": _condition(problem), "message": str(problem)}),
        "threshold": json_text(dict(check.rule.expectation or {})),
        "started_at": now,
        "finished_at": now,
        "execution_ms": 0,
    }


def _utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
