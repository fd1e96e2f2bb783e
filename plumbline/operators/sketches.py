"""Column profiles from mergeable sketches: no value is shuffled, and a new day is merged, not recounted.

One scan gives, for every part of a dataset (a day, say) and every column, exact
counts, extremes and sums, and a HyperLogLog sketch of its distinct values.  A
sketch has a fixed size, so what leaves a task does not depend on how many
values it has seen.  Sketches of parts are stored one generation per part, so a
part that is loaded again replaces its own; any set of parts is merged into a profile.

Counts, extremes and means are exact.  Distinct counts are estimates with a
relative standard error of 1.04 / sqrt(2 ** precision); ``exact_where_it_matters``
counts exactly only those columns whose role depends on it: the near-unique ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.operators import value_counts as C
from plumbline.operators.profile import type_name
from plumbline.sources.generations import begin, read_committed

#: binary logarithm of a sketch's registers: 16 KB each, standard error 0.8 %
PRECISION = 14
#: distinct values up to which estimates count as exact in ``within_bound``
EXACT_UP_TO = 256

SKETCHES_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("dataset_id", T.StringType()),
            ("part", T.StringType()),
            ("ordinal", T.IntegerType()),
            ("column", T.StringType()),
            ("dtype", T.StringType()),
            ("row_count", T.LongType()),
            ("null_count", T.LongType()),
            ("value_count", T.LongType()),
            ("min", T.DoubleType()),
            ("max", T.DoubleType()),
            ("total", T.DoubleType()),
            ("distinct_values", T.BinaryType()),
        )
    ]
)


def standard_error(precision: int = PRECISION) -> float:
    return 1.04 / (1 << precision) ** 0.5


def sketch(dataset_id: str, df: DataFrame, part: str = "'all'", precision: int = PRECISION) -> DataFrame:
    """One row per part and column: ``SKETCHES_SCHEMA``.

    ``part`` is an SQL expression over the dataset's columns; parts should be few
    (days, loads).  A null part is the part ''.
    """
    fields = list(enumerate(df.schema.fields))
    aggregates = ["count(1) as n"]
    rows = []
    for i, field in fields:
        c, kind = V.named(field.name), field.dataType
        value = V.groupable(c, kind)
        number = V.as_number(c, kind) if V.is_numeric(kind) or isinstance(kind, T.BooleanType) else "cast(null as double)"
        native = V.present(c, kind) if V.is_numeric(kind) else f"cast({c} as int)" if isinstance(kind, T.BooleanType) else number
        aggregates += [
            f"count_if({V.is_blank(c, kind)}) as nulls_{i}",
            f"count({value}) as values_{i}",
            f"cast(min({native}) as double) as min_{i}",
            f"cast(max({native}) as double) as max_{i}",
            f"sum({number}) as total_{i}",
            f"hll_sketch_agg(if({value} is null, null, xxhash64({value})), {precision}) as distinct_{i}",
        ]
        rows.append(
            f"struct({V.text_literal(dataset_id)} as dataset_id, part, {i} as ordinal, {V.text_literal(field.name)} as column, "
            f"'{type_name(kind)}' as dtype, n as row_count, nulls_{i} as null_count, values_{i} as value_count, "
            f"min_{i} as min, max_{i} as max, total_{i} as total, distinct_{i} as distinct_values)"
        )
    named = df.selectExpr(f"coalesce(cast({part} as string), '') as __part", *[V.named(f.name) for _, f in fields])
    grouped = named.groupBy(F.col("__part").alias("part")).agg(*map(F.expr, aggregates))
    return grouped.selectExpr(f"inline(array({', '.join(rows)}))")


def merge(sketches: DataFrame, precision: int = PRECISION) -> DataFrame:
    """The sketches of all parts as those of one part ''; merging is associative, so it can go in steps."""
    add = {c: F.sum(c).alias(c) for c in ("row_count", "null_count", "value_count", "total")}
    merged = sketches.groupBy("dataset_id", "ordinal", "column", "dtype").agg(
        *add.values(), F.min("min").alias("min"), F.max("max").alias("max"),
        F.expr("hll_union_agg(distinct_values, true)").alias("distinct_values"),
    )
    return merged.withColumn("part", F.lit("")).select(*SKETCHES_SCHEMA.names)


def profile_sketched(sketches: DataFrame, precision: int = PRECISION) -> DataFrame:
    """A profile row per column; ``distinct_count`` is an estimate, and ``distinct_error`` its standard error.

    An estimate never exceeds the values that were there.  What only exact counts of
    values can tell (the highest frequency, the frequent values) is not in it.
    """
    merged = merge(sketches, precision)
    estimate = F.least(F.expr("hll_sketch_estimate(distinct_values)"), F.col("value_count"))
    present = F.col("row_count") - F.col("null_count")

    def share(part, whole):
        return F.coalesce(part / F.nullif(whole, F.lit(0)).cast("double"), F.lit(0.0))

    return merged.withColumn("distinct_count", estimate).select(
        "dataset_id", "ordinal", "column", "dtype", "row_count", "null_count",
        share(F.col("null_count"), F.col("row_count")).alias("null_pct"),
        "distinct_count", present.alias("non_null_count"),
        F.least(share(F.col("distinct_count"), present), F.lit(1.0)).alias("distinct_ratio_non_null"),
        F.greatest(F.lit(0).cast("bigint"), present - F.col("distinct_count")).alias("duplicate_count"),
        "min", "max", (F.col("total") / F.nullif("value_count", F.lit(0).cast("bigint"))).alias("mean"),
        F.lit(standard_error(precision)).alias("distinct_error"),
    )


def near_unique(profiled: DataFrame, errors: float = 4.0) -> DataFrame:
    """(dataset_id, column) of the columns that may be unique: keys are among them.

    ``errors`` standard errors below one; a column below that has repeated values for
    all but one in some ten thousand tables.
    """
    least = 1 - errors * F.col("distinct_error")
    return profiled.where((F.col("non_null_count") > 0) & (F.col("distinct_ratio_non_null") >= least)).select("dataset_id", "column")


def exact_where_it_matters(profiled: DataFrame, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The sketched profile with exact distinct counts and highest frequencies of its near-unique columns.

    Only those columns are counted by value; of the others ``max_dup_count`` is null
    and ``exact`` false.  What is collected is one row per near-unique column.
    """
    wanted = sorted((r["dataset_id"], r["column"]) for r in near_unique(profiled).collect())
    counted = []
    for dataset_id, column in wanted:
        counts = C.value_counts(datasets[dataset_id], column).where("key is not null")
        counted.append(
            counts.agg(F.count(F.lit(1)).alias("__distinct"), F.max("n").alias("max_dup_count")).select(
                F.lit(dataset_id).alias("dataset_id"), F.lit(column).alias("column"), "__distinct", "max_dup_count"
            )
        )
    if not counted:
        none = F.lit(None).cast("bigint")
        return profiled.withColumns({"max_dup_count": none, "exact": F.lit(False)})
    found = profiled.join(C.union_all(counted), ["dataset_id", "column"], "left")
    present, distinct = F.col("non_null_count"), F.coalesce("__distinct", "distinct_count")
    return found.withColumns(
        {
            "exact": F.col("__distinct").isNotNull(),
            "distinct_count": distinct,
            "distinct_ratio_non_null": F.when(
                F.col("__distinct").isNotNull(), F.coalesce(distinct / F.nullif(present, F.lit(0).cast("bigint")).cast("double"), F.lit(0.0))
            ).otherwise(F.col("distinct_ratio_non_null")),
            "duplicate_count": F.greatest(F.lit(0).cast("bigint"), present - distinct),
        }
    ).select(*profiled.columns, "max_dup_count", "exact")


# --- stored sketches --------------------------------------------------------


def store(sketches: DataFrame, folder: str) -> None:
    """Keep the sketches, each part in the place of what it had before.

    Which parts there are is the only thing collected.  The sketches are a few
    rows a part, settled by the caller if they should not be computed for each part again.
    """
    spark = sketches.sparkSession
    for (part,) in sketches.select("part").distinct().collect():
        written = begin(spark, folder, "part", part)
        written.append(sketches.where(F.col("part") == part), "sketches", "dataset_id")
        written.commit()


def stored(spark: SparkSession, folder: str, parts: Iterable[str] | None = None) -> DataFrame:
    """The sketches of all parts, or of some."""
    found = read_committed(spark, folder, "sketches", "part", SKETCHES_SCHEMA)
    return found if parts is None else found.where(F.col("part").isin(list(parts)))
