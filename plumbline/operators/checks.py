"""From a rule to what Spark has to compute for it.

``compile_rule`` turns one rule into a :class:`Check`.  Mistakes that can be
seen without reading data (an unknown type, an absent column or dataset, a bad
parameter) become a ready verdict, so one broken rule never fails a run.  All
other rules name what they need: a row predicate and an aggregate for the shared
scan, and a grouping where the rule is about values rather than rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timezone
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.model import RULE_TYPES, Rule


@dataclass(frozen=True)
class Clock:
    """The moment freshness is judged at and the day date checks compare with."""

    now: datetime
    today: date

    @classmethod
    def at(cls, as_of: datetime | None = None) -> Clock:
        if as_of is None:
            return cls(datetime.now(timezone.utc), date.today())
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=timezone.utc)
        return cls(as_of.astimezone(timezone.utc), as_of.date())

    @property
    def micros(self) -> int:
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        delta = self.now - epoch
        return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


@dataclass(frozen=True)
class Grouping:
    """What to count by value: repeated keys, keys without a parent, or invalid values."""

    kind: str
    column: str
    parent_dataset: str | None = None
    parent_column: str | None = None
    by_hash: bool = False


@dataclass(frozen=True)
class Check:
    """One rule, ready to plan.

    ``verdict`` is set when no data is needed; else ``bad`` marks bad rows,
    ``latest`` is the aggregate that gives the latest moment (both SQL text), and
    ``grouping`` asks for value counts.  ``allowance`` is the number the measure may not exceed.
    """

    seq: int
    rule: Rule
    dataset: str
    threshold: dict[str, Any]
    verdict: tuple[str, dict[str, Any]] | None = None
    bad: str | None = None
    latest: str | None = None
    grouping: Grouping | None = None
    allowance: float = 0.0
    if_empty: dict[str, Any] | None = None


class BadRule(Exception):
    """A rule that cannot be planned; carries a stable code and its details."""

    def __init__(self, code: str, **details: Any) -> None:
        super().__init__(code)
        self.payload = {"error": code, **details}


def compile_rule(
    seq: int,
    rule: Rule,
    dataset_id: str,
    datasets: Mapping[str, DataFrame],
    clock: Clock,
) -> Check:
    expectation = rule.expectation if isinstance(rule.expectation, Mapping) else {}
    build = _BUILDERS.get(rule.rule_type)
    if build is None:
        verdict = ("fail", {"error": "unknown_rule_type", "rule_type": rule.rule_type})
        return Check(seq, rule, dataset_id, {}, verdict=verdict)
    try:
        parts = build(_Source(dataset_id, datasets), expectation, clock)
    except BadRule as problem:
        return Check(seq, rule, dataset_id, dict(expectation), verdict=("fail", problem.payload))
    return Check(seq=seq, rule=rule, **{"dataset": dataset_id, **parts})


@dataclass(frozen=True)
class _Source:
    dataset_id: str
    datasets: Mapping[str, DataFrame]

    def frame(self, dataset_id: str | None = None) -> DataFrame:
        wanted = dataset_id or self.dataset_id
        if wanted not in self.datasets:
            raise BadRule("missing_dataset", dataset_id=wanted)
        return self.datasets[wanted]

    def field(self, column: Any, dataset_id: str | None = None) -> tuple[str, T.DataType]:
        df = self.frame(dataset_id)
        # exact, case-sensitive lookup: the analyzer alone would accept another spelling
        kinds = {f.name: f.dataType for f in df.schema.fields}
        if column not in kinds:
            raise BadRule("missing_column", column=column)
        return V.named(column), kinds[column]


def _required(expectation: Mapping, name: str) -> str:
    value = expectation.get(name)
    if not isinstance(value, str):
        raise BadRule("bad_parameter", parameter=name)
    return value


def _number(expectation: Mapping, name: str, default: Any, convert: type) -> Any:
    value = expectation.get(name, default)
    try:
        return convert(value)
    except (TypeError, ValueError, OverflowError):
        raise BadRule("bad_parameter", parameter=name) from None


def _exact(value: Any) -> Decimal:
    """A number as it is written: whole numbers and decimals keep all their digits."""
    if isinstance(value, bool):
        return Decimal(int(value))
    try:
        return Decimal(str(value).strip())
    except InvalidOperation:
        raise ValueError(value) from None


def _formats(expectation: Mapping) -> tuple[str, ...]:
    formats = expectation.get("formats")
    if formats is None:
        return V.DATE_FORMATS
    if not isinstance(formats, (list, tuple)) or not all(isinstance(f, str) for f in formats) or not formats:
        raise BadRule("bad_parameter", parameter="formats")
    return tuple(formats)


def _schema(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    required = expectation.get("required_columns", [])
    if not isinstance(required, (list, tuple)):
        raise BadRule("bad_parameter", parameter="required_columns")
    have = set(source.frame().columns)
    missing = [name for name in required if name not in have]
    observed = {"missing_columns": missing, "required_columns": list(required)}
    return {
        "threshold": {"required_columns": list(required)},
        "verdict": ("fail" if missing else "pass", observed),
    }


def _completeness(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    column, kind = source.field(_required(expectation, "column"))
    allowance = _number(expectation, "max_null_percent", 0, float)
    return {
        "threshold": {"max_null_percent": allowance},
        "bad": V.is_blank(column, kind),
        "allowance": allowance,
    }


def _uniqueness(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    name = _required(expectation, "column")
    source.field(name)
    allowance = _number(expectation, "max_duplicates_allowed", 0, int)
    count_by = expectation.get("count_by", "value")
    if count_by not in ("value", "hash"):
        raise BadRule("bad_parameter", parameter="count_by")
    return {
        "threshold": {"max_duplicates_allowed": allowance},
        "grouping": Grouping("repeated", name, by_hash=count_by == "hash"),
        "allowance": float(allowance),
    }


def _range(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    column, kind = source.field(_required(expectation, "column"))
    if not V.can_be_number(kind):
        raise BadRule("bad_parameter", parameter="column", column_type=kind.simpleString())
    low, high = expectation.get("min"), expectation.get("max")
    native = V.is_integral(kind) or isinstance(kind, T.DecimalType)
    tests = [f"{column if native else V.as_number(column, kind)} is null"]
    for name, bound in (("min", low), ("max", high)):
        if bound is not None:
            tests.append(V.beyond(column, kind, _number(expectation, name, None, _exact), name == "max"))
    tests = [t for t in tests if t is not None]
    return {"threshold": {"min": low, "max": high}, "bad": f"({' or '.join(tests)})"}


def _domain(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    name = _required(expectation, "column")
    column, kind = source.field(name)
    allowed = expectation.get("allowed_values", [])
    if not isinstance(allowed, (list, tuple, set, frozenset)):
        raise BadRule("bad_parameter", parameter="allowed_values")
    try:
        ordered = sorted(set(allowed))
    except TypeError:
        raise BadRule("bad_parameter", parameter="allowed_values") from None
    return {
        "threshold": {"allowed_values": ordered},
        "bad": V.outside(column, kind, ordered),
        "grouping": Grouping("invalid", name),
    }


def _date_not_in_future(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    column, kind = source.field(_required(expectation, "column"))
    unit = expectation.get("unit")
    if not V.can_be_moment(kind, unit) or unit not in (None, "ns", *V.EPOCH_UNITS):
        raise BadRule("bad_parameter", parameter="column", column_type=kind.simpleString())
    return {
        "threshold": {"not_in_future": True},
        "bad": V.after_day(column, kind, clock.today, _formats(expectation), unit),
    }


def _referential_integrity(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    child_column = _required(expectation, "child_column")
    parent_dataset = _required(expectation, "parent_dataset")
    parent_column = _required(expectation, "parent_column")
    child_dataset = expectation.get("child_dataset") or source.dataset_id
    source.field(child_column, child_dataset)
    source.field(parent_column, parent_dataset)
    return {
        "dataset": child_dataset,
        "threshold": {"parent_column": parent_column},
        "grouping": Grouping("orphan", child_column, parent_dataset, parent_column),
    }


def _freshness(source: _Source, expectation: Mapping, clock: Clock) -> dict:
    name = expectation.get("ts_column") or expectation.get("column") or "ts_load"
    max_age = _number(expectation, "max_age_days", -1, int)
    threshold = {"max_age_days": max_age, "ts_column": name}
    if max_age < 0:
        error = "Incorrect Freshness requirement: max(age) is less than 0"
        return {"threshold": threshold, "verdict": ("fail", {"error": error, "ts_column": name})}
    try:
        column, kind = source.field(name)
    except BadRule:
        error = "missing_ts_column"
        return {"threshold": threshold, "verdict": ("fail", {"error": error, "ts_column": name})}
    unit = expectation.get("unit")
    if not V.can_be_moment(kind, unit) or unit not in (None, "ns", *V.EPOCH_UNITS):
        raise BadRule("bad_parameter", parameter="ts_column", column_type=kind.simpleString())
    return {
        "threshold": threshold,
        "latest": V.latest_micros(column, kind, _formats(expectation), unit),
        "allowance": float(max_age),
        "if_empty": {"error": "ts_column_not_parseable_or_all_null", "ts_column": name},
    }


_BUILDERS = {
    "schema": _schema,
    "completeness": _completeness,
    "uniqueness": _uniqueness,
    "range": _range,
    "domain": _domain,
    "date_not_in_future": _date_not_in_future,
    "referential_integrity": _referential_integrity,
    "freshness": _freshness,
}
assert set(_BUILDERS) == set(RULE_TYPES)
