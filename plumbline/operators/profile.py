"""Column profiles: one row per column of each dataset.

Two kinds of work on columnar sources.  Nulls, blanks, minimum, maximum and mean of all columns are
one aggregate over one scan.  Distinct count, highest frequency and the most
frequent values follow from exact value counts, one typed ``groupBy`` per
column: on a columnar source each reads its own column only, keys keep their
native type, and Spark reuses the counted shuffle for both consumers.

A row format (CSV, JSON) has to be parsed whole whatever columns are wanted.  There
all values of a row are turned into (column, value) pairs and counted together: one
parse and one ``groupBy`` give everything, however many columns there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.model import TOP_VALUES
from plumbline.operators import value_counts as C
from plumbline.session import settle, shared_folder

# The type names of a profile.
TYPE_NAMES = {
    T.ByteType: "int8",
    T.ShortType: "int16",
    T.IntegerType: "int32",
    T.LongType: "int64",
    T.FloatType: "float32",
    T.DoubleType: "float64",
    T.BooleanType: "bool",
    T.DateType: "datetime64[ns]",
    T.TimestampType: "datetime64[ns]",
    T.TimestampNTZType: "datetime64[ns]",
}


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"number({kind.precision},{kind.scale})"
    return TYPE_NAMES.get(type(kind), "object")


def profile(datasets: Mapping[str, DataFrame], max_top: int = TOP_VALUES, row_formats: Iterable[str] = ()) -> DataFrame:
    """The profile table of all given datasets, as one lazy plan.

    ``max_top`` is how many of a column's most frequent values are listed.
    ``row_formats`` names the datasets whose files hold rows; they are parsed once, the
    others have a branch per column.
    """
    by_row = set(row_formats)
    return C.union_all(
        [
            _profile_rows(d, df, max_top) if d in by_row and _in_one_key(df) else _profile_one(d, df, list(enumerate(df.schema.fields)), max_top)
            for d, df in datasets.items()
        ]
    )


def profile_in_batches(
    datasets: Mapping[str, DataFrame], columns: int, max_top: int = TOP_VALUES
) -> DataFrame:
    """The same table, computed now, ``columns`` of a dataset at a time.

    For very wide tables, whose plan as a whole would be too large; the few rows of each
    batch are settled.
    """
    tables = []
    for dataset_id, df in datasets.items():
        fields = list(enumerate(df.schema.fields))
        for start in range(0, len(fields), columns):
            tables.append(settle(_profile_one(dataset_id, df, fields[start : start + columns], max_top)))
    return C.union_all(tables)


def columnar(df: DataFrame) -> DataFrame:
    """A row-format dataset (CSV, JSON) rewritten once as Parquet in the shared folder.

    Its profile then reads each column by itself, instead of parsing all files again for
    every column.
    """
    path = f"{shared_folder(df.sparkSession)}/columnar-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _profile_one(
    dataset_id: str, df: DataFrame, fields: list[tuple[int, T.StructField]], max_top: int
) -> DataFrame:
    """All parts as one SQL statement, so that a wide table is still one analysis."""
    counts = ",\n".join(_counts_sql(i, f) for i, f in fields)
    spreads = "\nunion all ".join(
        f"select {i} as ordinal, count(1) as distinct_count, max(n) as max_dup_count from counts_{i}"
        for i, _ in fields
    )
    tops = "\nunion all ".join(_top_sql(i, f, _taken(f, max_top)) for i, f in fields)
    best = df.sparkSession.sql(f"with {counts}\n{tops}", df=df)
    listed = C.top_values(best, max_top, [(df, {i: f.name for i, f in fields})], best).selectExpr(
        "branch as ordinal",
        "transform(top, e -> struct(e.value as value, e.n as count)) as top_values",
    )
    return df.sparkSession.sql(
        f"""
        with {counts},
        stats as ({_statistics_sql(fields)}),
        spreads as ({spreads})
        select {V.text_literal(dataset_id)} as dataset_id, ordinal, column, dtype, row_count,
          null_count,
          coalesce(null_count / cast(nullif(row_count, 0) as double), 0D) as null_pct,
          distinct_count,
          coalesce(top_values, cast(array() as array<struct<value:string,count:bigint>>)) as top_values,
          row_count - null_count as non_null_count,
          coalesce(distinct_count / cast(nullif(row_count - null_count, 0) as double), 0D)
            as distinct_ratio_non_null,
          coalesce(max_dup_count, 0L) as max_dup_count,
          greatest(0L, row_count - null_count - distinct_count) as duplicate_count,
          min, max, mean
        from stats join spreads using (ordinal) left join {{listed}} using (ordinal)""",
        df=df,
        listed=listed,
    )


def _taken(field: T.StructField, max_top: int) -> int:
    """Frequent values that are taken before the shown ones are told: more of texts, which may tie."""
    return max(max_top, C.TIED) if V.is_text(V.key_type(field.dataType)) else max_top


def _column(field: T.StructField) -> str:
    """The column for a statement whose braces name frames."""
    return V.named(field.name).replace("{", "{{").replace("}", "}}")


def _statistics_sql(fields: list[tuple[int, T.StructField]]) -> str:
    """(ordinal, column, dtype, row_count, null_count, min, max, mean) from one aggregate."""
    aggregates = ["count(1) as n"]
    rows = []
    for i, field in fields:
        c, kind = _column(field), field.dataType
        aggregates.append(f"count_if({V.is_blank(c, kind)}) as nulls_{i}")
        measures = ["cast(null as double)"] * 3
        if V.is_numeric(kind) or isinstance(kind, T.BooleanType):
            # min and max on the native value; only the result becomes a double
            native = V.present(c, kind) if V.is_numeric(kind) else f"cast({c} as int)"
            aggregates += [
                f"cast(min({native}) as double) as min_{i}",
                f"cast(max({native}) as double) as max_{i}",
                f"avg({V.as_number(c, kind)}) as mean_{i}",
            ]
            measures = [f"min_{i}", f"max_{i}", f"mean_{i}"]
        rows.append(
            f"struct({i} as ordinal, {V.text_literal(field.name)} as column, "
            f"'{type_name(kind)}' as dtype, n as row_count, nulls_{i} as null_count, "
            f"{measures[0]} as min, {measures[1]} as max, {measures[2]} as mean)"
        )
    return f"select inline(array({', '.join(rows)})) from (select {', '.join(aggregates)} from {{df}})"


def _counts_sql(i: int, field: T.StructField) -> str:
    """(key, n) of the present values; white-space text counts as a value here."""
    key = V.groupable(_column(field), field.dataType)
    return (
        f"counts_{i} as (select key, count(1) as n from (select {key} as key from {{df}}) "
        "where key is not null group by key)"
    )


def _top_sql(i: int, field: T.StructField, max_top: int) -> str:
    """(branch, rank, value, n): most frequent first, ties by value in its own type.

    The limit applies to sorted counts, so Spark keeps ``max_top`` rows per task and
    merges those.
    """
    text = V.as_text("e.key", V.key_type(field.dataType))
    return f"""select {i} as branch, at + 1 as rank, {text} as value, -e.less as n from (
        select posexplode(array_sort(collect_list(struct(-n as less, key)))) as (at, e)
        from (select * from counts_{i} order by n desc, key limit {max_top}))"""


# --- row formats ------------------------------------------------------------

# A value takes one of these places of a key, by its type: whole numbers, dates and moments,
# fractions, decimals, text.  Each keeps the order and the equality of the type.
PLACES = {"l": "bigint", "d": "double", "x": "decimal(38,18)", "s": "string"}


def _placed(c: str, kind: T.DataType) -> tuple[str, str] | None:
    """Where a value goes in the key, and as what; None for types that have no place."""
    if V.is_integral(kind):
        return "l", f"cast({c} as bigint)"
    if isinstance(kind, T.BooleanType):
        return "l", f"cast(cast({c} as int) as bigint)"
    if isinstance(kind, T.DateType):
        return "l", f"cast(unix_date({c}) as bigint)"
    if isinstance(kind, T.TimestampType):
        return "l", f"unix_micros({c})"
    if isinstance(kind, T.TimestampNTZType):
        return "l", f"unix_micros({V.in_utc(c)})"
    if V.is_fractional(kind):
        return "d", f"cast({V.present(c, kind)} as double)"
    if isinstance(kind, T.DecimalType):
        fits = kind.scale <= 18 and kind.precision - kind.scale <= 20
        return ("x", f"cast({c} as decimal(38,18))") if fits else None
    return ("s", V.groupable(c, kind)) if V.is_text(V.key_type(kind)) else None


def _replaced(kind: T.DataType) -> str:
    """The text of a value from its place in the key."""
    if isinstance(kind, T.BooleanType):
        return V.as_text("cast(l as boolean)", kind)
    if isinstance(kind, T.DateType):
        return V.as_text("date_from_unix_date(cast(l as int))", kind)
    if isinstance(kind, T.TimestampType):
        return V.as_text("timestamp_micros(l)", kind)
    if isinstance(kind, T.TimestampNTZType):
        return f"cast({V.utc_clock('timestamp_micros(l)')} as string)"
    if V.is_integral(kind):
        return "cast(l as string)"
    if V.is_fractional(kind):
        return V.as_text(f"cast(d as {kind.simpleString()})", kind)
    return V.as_text(f"cast(x as {kind.simpleString()})", kind) if isinstance(kind, T.DecimalType) else "s"


def _in_one_key(df: DataFrame) -> bool:
    return all(_placed("c", f.dataType) for f in df.schema.fields)


def _profile_rows(dataset_id: str, df: DataFrame, max_top: int) -> DataFrame:
    """The profile of one dataset from one pass: count all (column, value) pairs, then sum up per column."""
    fields = list(enumerate(df.schema.fields))
    pairs = []
    for i, field in fields:
        c, kind = V.named(field.name), field.dataType
        place, value = _placed(c, kind)
        key = ", ".join(f"{value if p == place else f'cast(null as {t})'} as {p}" for p, t in PLACES.items())
        pairs.append(f"struct({i} as ordinal, {key}, {V.is_blank(c, kind)} as blank)")
    keys = ["ordinal", *PLACES, "blank"]
    counts = df.selectExpr(f"inline(array({', '.join(pairs)}))").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    measured = [i for i, f in fields if V.is_numeric(f.dataType) or isinstance(f.dataType, T.BooleanType)]
    number = f"if(ordinal in ({', '.join(map(str, [-1, *measured]))}), coalesce(cast(l as double), d, cast(x as double)), null)"
    there = f"coalesce({', '.join(f'cast({p} as string)' for p in PLACES)}) is not null"
    valued = counts.selectExpr("*", f"{number} as v", f"{there} as there")
    sums = valued.groupBy("ordinal").agg(
        *map(
            F.expr,
            (
                "sum(n) as rows", "sum(if(blank, n, 0L)) as nulls", "count_if(there) as distinct_count",
                "max(if(there, n, null)) as most", "min(v) as min", "max(v) as max",
                "sum(v * n) / sum(if(v is null, null, n)) as mean",
            ),
        )
    )
    order = ", ".join(["n desc", *PLACES])
    place = f"row_number() over (partition by ordinal order by {order})"
    taken = max(_taken(f, max_top) for _, f in fields)
    best = valued.where("there").withColumn("rank", F.expr(place)).where(F.col("rank") <= taken)
    text = " ".join(f"when {i} then {_replaced(f.dataType)}" for i, f in fields)
    best = best.selectExpr("ordinal as branch", "rank", f"case ordinal {text} end as value", "n")
    listed = C.top_values(best, max_top, [(df, {i: f.name for i, f in fields})], best).selectExpr(
        "branch as ordinal", "transform(top, e -> struct(e.value as value, e.n as count)) as top_values"
    )
    columns = ", ".join(f"struct({i} as ordinal, {V.text_literal(f.name)} as column, '{type_name(f.dataType)}' as dtype)" for i, f in fields)
    named = df.sparkSession.range(1).selectExpr(f"inline(array({columns}))")
    joined = named.join(sums, "ordinal", "left").join(listed, "ordinal", "left").selectExpr(
        "*", "coalesce(rows, 0L) as row_count", "coalesce(nulls, 0L) as null_count"
    )
    return joined.selectExpr(
        f"{V.text_literal(dataset_id)} as dataset_id", "ordinal", "column", "dtype", "row_count", "null_count",
        "coalesce(null_count / cast(nullif(row_count, 0) as double), 0D) as null_pct",
        "coalesce(distinct_count, 0L) as distinct_count",
        "coalesce(top_values, cast(array() as array<struct<value:string,count:bigint>>)) as top_values",
        "row_count - null_count as non_null_count",
        "coalesce(distinct_count / cast(nullif(row_count - null_count, 0) as double), 0D) as distinct_ratio_non_null",
        "coalesce(most, 0L) as max_dup_count",
        "greatest(0L, row_count - null_count - coalesce(distinct_count, 0L)) as duplicate_count",
        "min", "max", "mean",
    )
