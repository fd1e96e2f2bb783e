"""Small scalar expressions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def matching_patterns(name: Column, patterns: Iterable[str]) -> Column:
    """The regular expressions, in the given order, found in ``name`` in any case."""
    hits = [F.when(name.rlike("(?i)" + p), F.lit(p)) for p in patterns]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def safe_ratio(part: Column, whole: Column, scale: float = 1.0, empty: float = 0.0) -> Column:
    """part / whole * scale in doubles, ``empty`` where whole is zero."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * F.lit(scale)
    return F.coalesce(ratio, F.lit(empty))


def utc_text(micros: str) -> str:
    """SQL: epoch microseconds as ``yyyy-MM-dd HH:mm:ss[.ffffff]+00:00``."""
    seconds = f"cast(({micros}) div 1000000L - if(pmod({micros}, 1000000L) > 0 and ({micros}) < 0, 1, 0) as decimal(18,6))"
    moment = f"(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"
    fraction = f"if(pmod({micros}, 1000000L) > 0, format_string('.%06d', pmod({micros}, 1000000L)), '')"
    return f"concat(date_format({moment}, 'yyyy-MM-dd HH:mm:ss'), {fraction}, '+00:00')"
