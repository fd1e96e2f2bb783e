"""CSV with a fixed set of null tokens and types found by one aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plumbline.functions import values as V

# The texts read as null.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The texts read as booleans.
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")

INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    null_tokens: Iterable[str] = NULL_TOKENS,
    **options: str,
) -> DataFrame:
    """Read CSV with a header line.

    ``options`` go to the reader; ``multiLine="true"`` reads fields with line breaks,
    at the price that a file is read by one task.  With a ``schema`` the files are read once, and values that do not fit become
    null.  Without one a first pass finds the narrowest of bigint, double, boolean
    and string for each column, all columns in one aggregate.
    """
    raw = spark.read.options(header="true", inferSchema="false", escape='"', **options).csv(path)
    tokens = list(null_tokens)
    listed = ", ".join(V.text_literal(t) for t in tokens)
    texts = raw.selectExpr(
        *[f"if({V.named(c)} in ({listed}), null, {V.named(c)}) as {V.named(c)}" for c in raw.columns]
    )
    kinds = _infer(texts) if schema is None else {f.name: f.dataType for f in schema.fields}
    wanted = texts.columns if schema is None else schema.fieldNames()
    return texts.selectExpr(*[f"{_typed(c, kinds[c])} as {V.named(c)}" for c in wanted])


def _type_tests(c: str) -> dict[str, str]:
    booleans = ", ".join(f"'{t}'" for t in BOOLEAN_TOKENS)
    return {
        "bigint": f"{c} rlike r'{INTEGER_PATTERN}' and try_cast(btrim({c}, {V.SPACE}) as bigint) is not null",
        "double": f"{V.as_number(c, T.StringType())} is not null",
        "boolean": f"{c} in ({booleans})",
    }


def _infer(texts: DataFrame) -> dict[str, T.DataType]:
    aggregates = []
    for i, name in enumerate(texts.columns):
        c = V.named(name)
        aggregates.append(f"count({c}) as `{i}_present`")
        for kind, test in _type_tests(c).items():
            aggregates.append(f"count_if({test}) as `{i}_{kind}`")
    seen = texts.selectExpr(*aggregates).first()
    kinds: dict[str, T.DataType] = {}
    for i, name in enumerate(texts.columns):
        present = seen[f"{i}_present"]
        fits = [kind for kind in _KINDS if present and seen[f"{i}_{kind}"] == present]
        kinds[name] = _KINDS[fits[0]] if fits else T.StringType()
    return kinds


_KINDS = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _typed(name: str, kind: T.DataType) -> str:
    c, wanted = V.named(name), kind.simpleString()
    if V.is_text(kind):
        return c
    if V.is_fractional(kind):
        return f"cast({V.as_number(c, T.StringType())} as {wanted})"
    if V.is_moment(kind):
        return f"cast({V.as_timestamp(c, T.StringType())} as {wanted})"
    return f"try_cast(btrim({c}, {V.SPACE}) as {wanted})"
