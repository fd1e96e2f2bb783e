"""Counting by value, and finding the rows behind a set of keys.

Counts are always taken before anything is joined or ranked: the map side
combines equal keys, so a key that holds a third of all rows arrives as one
record per task.  Long texts travel as digests; the few that a report shows are
looked up at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import values as V
from plumbline.session import settle

# The most frequent keys are handled apart; every other key then holds at most
# 1 / (HOT_KEYS + 1) of the rows.
HOT_KEYS = 1_000
# Keys of a branch that may tie at the cut and be looked up whole; what ties beyond goes by key.
TIED = 500
# Hashes of eight bytes that may be broadcast to find the rows of repeated keys.
BROADCAST_HASHES = 1_000_000


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def kind_of(df: DataFrame, column: str) -> T.DataType:
    return next(f.dataType for f in df.schema.fields if f.name == column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(key, n) for every value of the column; null is a value."""
    key = V.groupable(V.named(column), kind_of(df, column))
    return df.selectExpr(f"{key} as key").groupBy("key").agg(F.expr("count(1) as n"))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, n) of the values that occur more than once."""
    return value_counts(df, column).where("n > 1")


def repeated_keys_by_hash(df: DataFrame, column: str) -> DataFrame:
    """The same as ``repeated_keys``, in two passes that move hashes instead of keys.

    First the 64-bit hashes of all keys are counted: a row of 16 bytes for each key and
    task, however long the key.  Where the hashes met more than once are few (their
    number is checked) they are broadcast, and only rows with one of them are counted by
    key, which is exact, since equal keys have equal hashes.  Where they are many, most
    keys are repeated and counting them directly moves little.
    """
    key = V.groupable(V.named(column), kind_of(df, column))
    keyed = df.selectExpr(f"{key} as key").withColumn("__hash", F.xxhash64("key"))
    met = keyed.groupBy("__hash").agg(F.expr("count(1) as n")).where("n > 1").select("__hash")
    met = settle(met)
    if met.count() > BROADCAST_HASHES:
        return repeated_keys(df, column)
    suspects = keyed.join(F.broadcast(met), "__hash", "left_semi")
    return suspects.groupBy("key").agg(F.expr("count(1) as n")).where("n > 1")


def orphan_keys(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """(key, n) of the non-blank child values that no parent row has.

    Both sides are reduced to distinct keys first, so the anti-join sees each
    key once however often it occurs.
    """
    child_kind, parent_kind = kind_of(child, child_column), kind_of(parent, parent_column)
    here, there = V.named(child_column), V.named(parent_column)
    key, _, parent_key = V.same_footing(here, child_kind, there, parent_kind)
    counts = (
        child.where(f"not {V.is_blank(here, child_kind)}")
        .selectExpr(f"{key} as key")
        .groupBy("key")
        .agg(F.expr("count(1) as n"))
    )
    known = parent.selectExpr(f"{parent_key} as key").distinct()
    return counts.join(known, "key", "left_anti")


def met_counts(
    sides: list[tuple[DataFrame, str, dict[str, str]]], branches: dict[int, tuple[str, str]], kind: T.DataType
) -> DataFrame:
    """(branch, value, n) of several counts over the same keys, in one shuffle and without a join.

    ``sides`` are frames with their key and, by name, the predicates of the rows to be
    counted; the keys of all sides meet in one row with all counts.  ``branches`` gives,
    per branch number, which keys belong to it and its count, in terms of these names.
    """
    names = [name for _, _, counted in sides for name in counted]
    rows = []
    for df, key, counted in sides:
        flags = [f"{counted.get(name, 'false')} as {name}" for name in names]
        rows.append(df.where(" or ".join(counted.values())).selectExpr(f"{key} as key", *flags))
    met = union_all(rows).groupBy("key").agg(*[F.expr(f"count_if({name}) as {name}") for name in names])
    if len(branches) == 1:
        ((branch, (wanted, n)),) = branches.items()
        return key_texts(met.where(wanted).selectExpr("key", f"{n} as n"), branch, kind)
    found = [f"if({wanted}, struct({branch} as branch, value, {n} as n), null)" for branch, (wanted, n) in branches.items()]
    return met.selectExpr("*", f"{V.as_text('key', kind)} as value").selectExpr(f"inline(array_compact(array({', '.join(found)})))")


def invalid_values(df: DataFrame, tests: dict[int, tuple[str, str]]) -> DataFrame:
    """(branch, value, n) of the bad values of several columns, in one scan.

    ``tests`` gives, per branch number, the column and the predicate of its bad rows.
    """
    found = []
    for branch, (column, bad) in tests.items():
        kind = kind_of(df, column)
        value = V.as_text(V.groupable(V.named(column), kind), V.key_type(kind))
        found.append(f"if({bad}, struct({branch} as branch, {value} as value), null)")
    return (
        df.selectExpr(f"inline(array_compact(array({', '.join(found)})))")
        .groupBy("branch", "value")
        .agg(F.expr("count(1) as n"))
    )


def key_texts(keys: DataFrame, branch: int, kind: T.DataType) -> DataFrame:
    """(branch, value, n) with the key as text."""
    return keys.selectExpr(f"{branch} as branch", f"{V.as_text('key', kind)} as value", "n")


def totals(counted: DataFrame) -> DataFrame:
    """Per branch: rows, surplus rows and keys."""
    return counted.groupBy("branch").agg(
        F.expr("sum(n) as rows"), F.expr("sum(n - 1) as surplus"), F.expr("count(1) as keys")
    )


def levels(counted: DataFrame) -> DataFrame:
    """(branch, n, keys): how many keys of each branch occur n times."""
    return counted.groupBy("branch", "n").agg(F.expr("count(1) as keys"))


def totals_of_levels(leveled: DataFrame) -> DataFrame:
    """``totals`` from the levels of the same counts."""
    return leveled.groupBy("branch").agg(
        F.expr("sum(n * keys) as rows"), F.expr("sum((n - 1) * keys) as surplus"), F.expr("sum(keys) as keys")
    )


def top_rows_by_level(counted: DataFrame, leveled: DataFrame, limit: int) -> DataFrame:
    """The same as ``top_rows``, sorting only keys as frequent as the ``limit``-th of their branch.

    Keys that occur n times are at most one in n rows, so there are few levels however
    many keys: they are ordered to find the frequency at which the limit is reached.
    """
    order = Window.partitionBy("branch").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = leveled.withColumn("upto", F.sum("keys").over(order))
    least = reached.groupBy("branch").agg(F.expr(f"coalesce(max(n) filter (where upto >= {limit}), 0) as least"))
    frequent = counted.join(F.broadcast(least), "branch").where("n >= least").drop("least")
    return top_rows(frequent, limit)


def top_rows(counted: DataFrame, limit: int) -> DataFrame:
    """(branch, rank, value, n): the ``limit`` most frequent values of each branch.

    Ties go by value.  The rank filter becomes a window group limit, which cuts
    every partition to ``limit`` rows per branch before the shuffle.
    """
    order = Window.partitionBy("branch").orderBy(F.desc("n"), F.asc("value"))
    ranked = counted.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= limit)


def as_array(best: DataFrame) -> DataFrame:
    """(branch, top): the ranked rows of each branch as one short array."""
    ordered = "array_sort(collect_list(struct(rank, value, n)))"
    top = f"transform({ordered}, e -> struct(e.value as value, e.n as n)) as top"
    return best.groupBy("branch").agg(F.expr(top))


def _long_texts(sources: list[tuple[DataFrame, dict[int, str]]]) -> tuple[DataFrame | None, list[int]]:
    """(branch, value, whole) of the rows with long texts, and the branches that count texts.

    ``value`` is the key that stands for the text.
    """
    found, branches = [], []
    for df, columns in sources:
        entries = []
        for branch, column in columns.items():
            c, kind = V.named(column), kind_of(df, column)
            if V.is_text(V.key_type(kind)):
                text = V.whole_text(c, kind)
                entry = f"struct({branch} as branch, {V.groupable(c, kind)} as value, {text} as whole)"
                entries.append(f"if({V.is_long(text)}, {entry}, null)")
                branches.append(branch)
        if entries:
            found.append(df.selectExpr(f"inline(array_compact(array({', '.join(entries)})))"))
    return (union_all(found) if found else None), branches


def top_values(
    counted: DataFrame, limit: int, sources: list[tuple[DataFrame, dict[int, str]]], best: DataFrame | None = None
) -> DataFrame:
    """(branch, top): the ``limit`` most frequent values of each branch, ties by value, long texts whole.

    Keys order like the texts they stand for, but for long texts that begin alike.  So
    more rows than are shown are taken by key (``best``, if it is there already), and
    those that tie with the last one shown, and begin like it, are looked up with the
    shown ones and ordered whole.  ``sources`` lists frames with the column each branch
    counts.  Only digests are broadcast, at most ``TIED`` per branch; where there are
    none the broadcast side is empty and the frames are not read again.
    """
    best = top_rows(counted, max(limit, TIED)) if best is None else best
    # a row per branch: both uses of it share one shuffle
    base = best.groupBy("branch").agg(F.expr("array_sort(collect_list(struct(rank, value, n))) as found"))
    texts, branches = _long_texts(sources)
    if texts is None:
        return base.selectExpr("branch", f"transform(slice(found, 1, {limit}), e -> struct(e.value as value, e.n as n)) as top")
    of_texts = f"branch in ({', '.join(map(str, branches))})"
    last = f"found[least(size(found), {limit}) - 1]"
    tied = f"{of_texts} and e.n = {last}.n and {V.is_long('e.value')} and {V.beginning('e.value')} = {V.beginning(last + '.value')}"
    tops = base.selectExpr("branch", f"filter(found, e -> e.rank <= {limit} or coalesce({tied}, false)) as top")
    # not a filter, which would be pushed into the counts and have them read once more for these branches
    shown = f"if({of_texts}, top.value, cast(array() as array<string>))"
    digests = tops.selectExpr("branch", f"explode({shown}) as value").where(V.is_long("value"))
    wanted = texts.join(F.broadcast(digests), ["branch", "value"])
    # Equal digests, equal texts: the set of each has one element.  Unlike any_value, it is
    # aggregated in a hash map, so the rows of a frequent text are not sorted.
    single = wanted.groupBy("branch", "value").agg(F.expr("collect_set(whole)[0] as whole"))
    whole = single.groupBy("branch").agg(F.expr("map_from_entries(collect_list(struct(value, whole))) as whole"))
    told = "transform(top, e -> struct(coalesce(try_element_at(whole, e.value), e.value) as value, e.n as n))"
    by_text = f"transform(array_sort(transform({told}, e -> struct(-e.n as less, e.value as value))), e -> struct(e.value as value, -e.less as n))"
    return tops.join(whole, "branch", "left").selectExpr("branch", f"slice(if({of_texts}, {by_text}, {told}), 1, {limit}) as top")


def rows_with_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """All rows of ``df`` whose ``key`` is in ``keys`` (key, n), null matching null.

    The ``HOT_KEYS`` most frequent keys, a fixed number of bounded size, are broadcast:
    their rows are found, and taken out of the rest, without a shuffle.  What is left is
    joined by key, where no key is large.
    """
    marked = df.withColumn("__key", F.expr(key))

    def joined(rows: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = some.select(F.col("key").alias("__wanted"))
        return rows.join(some, F.col("__key").eqNullSafe(F.col("__wanted")), how)

    hot = F.broadcast(keys.orderBy(F.desc("n"), F.asc("key")).limit(HOT_KEYS))
    frequent = joined(marked, hot, "left_semi")
    others = joined(joined(marked, hot, "left_anti"), keys, "left_semi")
    return frequent.unionByName(others).drop("__key")
