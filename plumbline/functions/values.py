"""SQL expressions that read dirty values: blank, number, date, text.

Every function takes a column expression and its Spark type and gives SQL text for
``F.expr`` / ``selectExpr``: typed columns keep their native comparison (and parquet
pushdown), and only text pays for parsing.  As text, one expression is one call into
the JVM however deep it is, so wide rule sets and tables are planned quickly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, InvalidOperation
from typing import Any

from pyspark.sql import types as T

from plumbline.model import value_text

# The characters Python counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a number in text, and the date formats tried in order.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
ISO_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"
ZONED_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}[T ].*[A-Za-z+-]"
DATE_FORMATS = ("iso", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")

EPOCH_UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1}

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)

# Texts are grouped, joined and shuffled by their first characters and, where they have more,
# the SHA-256 digest of the whole, so no key takes more than 271 characters.  A key with a
# digest is longer than the limit, so no short text can be mistaken for one.  Keys order like
# their texts, but for long ones that begin alike; reports look those up.
KEY_CHARACTERS = 200
DIGEST_PREFIX = "sha256:"


def named(name: str) -> str:
    """The column of exactly this name, whatever characters are in it."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A SQL string literal for any text."""
    plain = (ch if " " <= ch <= "~" and ch not in "'\\{}" else _escaped(ch) for ch in text)
    return "'" + "".join(plain) + "'"


def _escaped(ch: str) -> str:
    return f"\\u{ord(ch):04x}" if ord(ch) < 0x10000 else f"\\U{ord(ch):08x}"


def number_literal(value: float, kind: T.DataType | None = None) -> str:
    """A double, or a float for a column of that type, whose values are no nearer to the number."""
    name = "float" if isinstance(kind, T.FloatType) else "double"
    return f"{name}({text_literal(repr(float(value)))})"


def exact_literal(value: Decimal) -> str | None:
    """A decimal literal, null if it takes more digits than a decimal column can hold."""
    text = format(value, "f")
    return f"{text}BD" if len(text.strip("-").replace(".", "")) <= 38 else None


def beyond(c: str, kind: T.DataType, bound: Decimal | float, above: bool) -> str | None:
    """A value over the bound (``above``) or under it; null where no value can be.

    Whole and decimal columns are compared as they are, so large values stay exact and
    the comparison reaches the file scan; fractions are compared in their own type, text as doubles.
    """
    sign = ">" if above else "<"
    if isinstance(kind, T.FloatType):
        return f"{present(c, kind)} {sign} {number_literal(float(bound), kind)}"
    if not (is_integral(kind) or isinstance(kind, T.DecimalType)):
        return f"{as_number(c, kind)} {sign} {number_literal(float(bound))}"
    exact = Decimal(str(bound))
    if not exact.is_finite():
        return None if exact.is_nan() or above == (exact > 0) else f"{c} is not null"
    if is_integral(kind):
        exact = exact.to_integral_value(ROUND_FLOOR if above else ROUND_CEILING)
        if abs(exact) > MAX_BIGINT:
            return None if above == (exact > 0) else f"{c} is not null"
        return f"{c} {sign} bigint('{int(exact)}')"
    literal = exact_literal(exact)
    return f"{c} {sign} {literal}" if literal else f"{as_number(c, kind)} {sign} {number_literal(float(exact))}"


MAX_BIGINT = 2**63 - 1


def _pattern(pattern: str) -> str:
    return f"r'{pattern}'"


SPACE = text_literal(WHITESPACE)


def is_integral(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType)


def is_fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def is_moment(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def present(c: str, kind: T.DataType) -> str:
    """The value with NaN turned into null."""
    return f"nanvl({c}, cast(null as {kind.simpleString()}))" if is_fractional(kind) else c


def is_blank(c: str, kind: T.DataType) -> str:
    """Null, NaN, or text of white space only.

    Most texts begin with a visible ASCII character, which two comparisons tell; only
    the others are trimmed, and trimming on the left stops at the first other character.
    """
    if is_text(kind):
        visible = f"{c} >= '!' and {c} < '\\u0080'"
        return f"({c} is null or (not ({visible}) and trim(leading {SPACE} from {c}) = ''))"
    if is_fractional(kind):
        return f"({c} is null or isnan({c}))"
    return f"({c} is null)"


def can_be_number(kind: T.DataType) -> bool:
    return is_numeric(kind) or is_text(kind) or isinstance(kind, T.BooleanType)


def as_number(c: str, kind: T.DataType) -> str:
    """Double value, null where there is none."""
    if is_text(kind):
        number = f"if({c} rlike {_pattern(NUMBER_PATTERN)}, try_cast({c} as double), null)"
        overflow = f"abs({number}) = double('infinity') and not contains(lower({c}), 'inf')"
        return f"if({overflow}, null, {number})"
    if isinstance(kind, T.BooleanType):
        return f"cast(cast({c} as int) as double)"
    return f"cast({present(c, kind)} as double)"


def as_timestamp(
    c: str, kind: T.DataType, formats: Iterable[str] = DATE_FORMATS, unit: str | None = None
) -> str:
    """Timestamp, null where the value does not parse in any of the formats."""
    if is_text(kind):
        text = f"btrim({c}, {SPACE})"
        readings = [_iso(text) if fmt == "iso" else _formatted(text, fmt) for fmt in formats]
        return f"coalesce({', '.join(readings)})"
    if is_numeric(kind) and unit:
        value = present(c, kind)
        micros = f"{value} / 1000" if unit == "ns" else f"try_multiply({value}, {EPOCH_UNITS[unit]}L)"
        return f"timestamp_micros(try_cast({micros} as bigint))"
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return in_utc(c)
    return f"cast({c} as timestamp)"


def in_utc(c: str) -> str:
    """A date or a timestamp without zone as the moment it is in UTC, whatever the session's zone."""
    return f"try_cast(concat(cast(cast({c} as timestamp_ntz) as string), 'Z') as timestamp)"


def utc_clock(c: str) -> str:
    """What a clock in UTC shows at a moment, as a timestamp without zone."""
    seconds = f"cast(cast(unix_micros({c}) as decimal(24,0)) / 1000000BD as decimal(18,6))"
    return f"(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


def _iso(text: str) -> str:
    zoned = f"try_cast({text} as timestamp)"
    plain = in_utc(f"try_cast({text} as timestamp_ntz)")
    return f"if({text} rlike {_pattern(ISO_PATTERN)}, if({text} rlike {_pattern(ZONED_PATTERN)}, {zoned}, {plain}), null)"


def _formatted(text: str, fmt: str) -> str:
    read = f"try_to_timestamp({text}, {text_literal(fmt)})"
    if not re.search("[VzOXxZ]", re.sub("'[^']*'", "", fmt)):
        read = f"try_to_timestamp(concat({text}, ' Z'), {text_literal(fmt + ' X')})"
    return f"if({text} rlike {_pattern(_shape(fmt))}, {read}, null)"


def _shape(fmt: str) -> str:
    """A pattern every text of a date format has, to keep other texts from the parser."""
    parts = []
    for run in re.finditer(r"([A-Za-z])\1*|'[^']*'|[^A-Za-z']", fmt):
        letters = run.group()
        if letters[0] in "yMdHhms" and not (letters[0] == "M" and len(letters) > 2):
            parts.append(r"\d{4}" if letters == "yyyy" else r"\d+")
        elif letters[0].isalpha() or letters[0] == "'":
            parts.append(".+")
        else:
            parts.append(re.escape(letters))
    return "^" + "".join(parts) + "$"


def can_be_moment(kind: T.DataType, unit: str | None = None) -> bool:
    return is_text(kind) or is_moment(kind) or (is_numeric(kind) and unit is not None)


def after_day(
    c: str,
    kind: T.DataType,
    day: date,
    formats: Iterable[str] = DATE_FORMATS,
    unit: str | None = None,
) -> str:
    """No readable date, or a date later than ``day``."""
    if isinstance(kind, T.DateType):
        return f"({c} is null or {c} > date'{day.isoformat()}')"
    midnight = f"{(day + timedelta(days=1)).isoformat()} 00:00:00"
    if isinstance(kind, T.TimestampNTZType):
        return f"({c} is null or {c} >= timestamp_ntz'{midnight}')"
    moment = as_timestamp(c, kind, formats, unit)
    return f"coalesce({moment} >= timestamp_ltz'{midnight}Z', true)"


def latest_micros(
    c: str, kind: T.DataType, formats: Iterable[str] = DATE_FORMATS, unit: str | None = None
) -> str:
    """Aggregate: the latest moment as microseconds since the epoch, zone-less values read as UTC.

    The maximum is taken on the native value; only the result is converted.
    """
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return f"unix_micros({in_utc(f'max({c})')})"
    return f"unix_micros(max({as_timestamp(c, kind, formats, unit)}))"


def as_text(c: str, kind: T.DataType) -> str:
    """Display text; booleans and doubles are written the way Python writes them."""
    if is_text(kind):
        return c
    if isinstance(kind, T.BooleanType):
        return f"initcap(cast({c} as string))"
    if is_fractional(kind):
        digits = f"cast(try_cast({c} as decimal(38,21)) as string)"
        plain = f"regexp_replace({digits}, {_pattern(TRAILING_ZEROS)}, '$1')"
        size = f"abs({c})"
        wide = f"({size} >= 1e7 and {size} < 1e16) or ({size} >= 1e-4 and {size} < 1e-3)"
        return f"if({wide}, {plain}, cast({c} as string))"
    if isinstance(kind, NESTED):
        return f"to_json({c})"
    if isinstance(kind, T.TimestampType):
        return f"cast({utc_clock(c)} as string)"
    return f"cast({c} as string)"


TRAILING_ZEROS = r"([.][0-9]+?)0*$"


def whole_text(c: str, kind: T.DataType) -> str:
    return f"to_json({c})" if isinstance(kind, NESTED) else c


def is_long(text: str) -> str:
    return f"char_length({text}) > {KEY_CHARACTERS}"


def beginning(text: str) -> str:
    """What a key of a long text and the text have in common."""
    return f"left({text}, {KEY_CHARACTERS})"


def groupable(c: str, kind: T.DataType) -> str:
    """A short form of the value that is equal exactly where the value is equal."""
    if isinstance(kind, T.BinaryType):
        short = f"concat(substring({c}, 1, {KEY_CHARACTERS}), unhex(sha2({c}, 256)))"
        return f"if(octet_length({c}) > {KEY_CHARACTERS}, {short}, {c})"
    if not is_text(key_type(kind)):
        return present(c, kind)
    text = whole_text(c, kind)
    short = f"concat(left({text}, {KEY_CHARACTERS}), '{DIGEST_PREFIX}', sha2({text}, 256))"
    return f"if({is_long(text)}, {short}, {text})"


def key_type(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, NESTED) else kind


def outside(c: str, kind: T.DataType, allowed: Iterable[Any]) -> str:
    """A value that is not blank and not in the allow-list."""
    texts = [value_text(v) for v in allowed]
    if is_integral(kind):
        value, listed = c, [f"bigint('{t}')" for t in texts if _is_plain_int(t)]
    elif isinstance(kind, T.DecimalType):
        exact = [d for d in map(_decimal_or_none, texts) if d is not None]
        value, listed = c, [t for t in map(exact_literal, exact) if t]
    elif is_numeric(kind):
        numbers = [f for f in map(_float_or_none, texts) if f is not None]
        value, listed = c, [number_literal(f, kind) for f in numbers]
    else:
        value, listed = as_text(c, kind), [text_literal(t) for t in texts]
    if not listed:
        return f"(not {is_blank(c, kind)})"
    return f"(not {is_blank(c, kind)} and {value} not in ({', '.join(listed)}))"


def _is_plain_int(text: str) -> bool:
    digits = text[1:] if text[:1] == "-" else text
    return digits.isascii() and digits.isdigit() and len(digits) < 20 and str(int(text)) == text and abs(int(text)) <= MAX_BIGINT


def _decimal_or_none(text: str) -> Decimal | None:
    try:
        value = Decimal(text)
    except InvalidOperation:
        return None
    return value if value.is_finite() else None


def _float_or_none(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def same_footing(
    left: str, left_kind: T.DataType, right: str, right_kind: T.DataType
) -> tuple[str, T.DataType, str]:
    """Both sides of a key comparison in one type: native where possible, else text."""
    if left_kind == right_kind:
        return groupable(left, left_kind), key_type(left_kind), groupable(right, right_kind)
    if is_integral(left_kind) and is_integral(right_kind):
        return f"cast({left} as bigint)", T.LongType(), f"cast({right} as bigint)"
    exact = _common_decimal(left_kind, right_kind)
    if exact is not None:
        name = exact.simpleString()
        return f"cast({left} as {name})", exact, f"cast({right} as {name})"
    if is_fractional(left_kind) and is_fractional(right_kind):
        return as_number(left, left_kind), T.DoubleType(), as_number(right, right_kind)
    if is_numeric(left_kind) and is_numeric(right_kind):
        return exact_text(left, left_kind), T.StringType(), exact_text(right, right_kind)
    if is_moment(left_kind) and is_moment(right_kind):
        return as_timestamp(left, left_kind), T.TimestampType(), as_timestamp(right, right_kind)
    text = T.StringType()
    left_text, right_text = as_text(left, left_kind), as_text(right, right_kind)
    return groupable(left_text, text), text, groupable(right_text, text)


def exact_text(c: str, kind: T.DataType) -> str:
    """A number in plain digits, the same for equal numbers of any type.

    For types without a common one: decimals of more than 38 digits together, and
    fractions beside whole numbers or decimals.  A fraction that is whole has all its
    digits, another one the shortest decimal that stands for it.
    """
    if is_integral(kind):
        return f"cast({c} as string)"
    if isinstance(kind, T.DecimalType):
        return _plain_digits(c, kind.scale)
    number = present(c, kind)
    near = f"try_cast({number} as decimal(38,18))"
    shortest = f"if(cast({near} as {kind.simpleString()}) = {number}, {_plain_digits(near, 18)}, cast({number} as string))"
    whole = f"cast(coalesce(try_cast({number} as bigint), try_cast({number} as decimal(38,0))) as string)"
    return f"if(rint({number}) = {number} and abs({number}) < 1e38D, {whole}, {shortest})"


def _plain_digits(c: str, scale: int) -> str:
    """All digits of a decimal, without grouping, and without zeros behind the last one that counts."""
    digits = f"translate(format_number({c}, {scale}), ',', '')"
    return f"regexp_replace({digits}, {_pattern(NO_FRACTION)}, '')" if scale else digits


NO_FRACTION = r"([.]0+|(?<=[.][0-9]{0,38}[1-9])0+)$"


def _common_decimal(left: T.DataType, right: T.DataType) -> T.DecimalType | None:
    """A decimal that holds every value of two whole or decimal types, if 38 digits are enough."""
    digits = scale = 0
    for kind in (left, right):
        if is_integral(kind):
            digits = max(digits, 19)
        elif isinstance(kind, T.DecimalType):
            digits, scale = max(digits, kind.precision - kind.scale), max(scale, kind.scale)
        else:
            return None
    return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
