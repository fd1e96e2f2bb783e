"""Mixing sources to target weights by Poisson replication.

A source's mean repetition is its target share over its actual share.  Every
document draws its count by inverting the Poisson distribution at a number
hashed from its id, is exploded by that count, and the copies are spread and
ordered by a second hash.  Built-in column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import shuffle_width

SEED = "mix-1"
#: exponent of the actual sizes in the target weights where none are given: 0 equal, 1 as they are
EXPONENT = 0.5
#: parts that the rows of a source are dealt to
PARTS = 32


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(2**52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """One row per source: size in characters, mean repetition and the table of the distribution.

    ``weights`` are target shares (normalised here; sources not named get none,
    the key "" stands for a null source); without them the target is the actual size to the
    power ``EXPONENT``.  ``budget`` is the size of the mixture over that of the
    corpus.  An empty text counts one character, so no source is without size.
    """
    size = F.greatest(F.char_length(F.coalesce("text", F.lit(""))), F.lit(1))
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("_source")).agg(F.sum(size.cast("double")).alias("size"))
    if weights is None:
        aim = F.pow("size", F.lit(EXPONENT))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        aim = F.coalesce(F.element_at(F.create_map(*pairs), F.col("_source")), F.lit(0.0)) if pairs else F.lit(0.0)
    aimed = sizes.withColumn("aim", aim)
    total = aimed.agg(F.sum("size").alias("all_size"), F.sum("aim").alias("all_aim"))
    mean = F.when(F.col("all_aim") > 0, F.col("aim") / F.col("all_aim") * F.col("all_size") * budget / F.col("size")).otherwise(0.0)
    # one row on the right: a scalar, not a product of tables
    rated = aimed.join(F.broadcast(total)).select("_source", "size", mean.alias("mean_repeats"))
    return rated.withColumn("steps", _cumulative(F.col("mean_repeats")))


def _cumulative(mean: Column) -> Column:
    """P(count <= k) for k = 0 .. far beyond the mean, in logarithms so that no mean underflows."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 25).cast("int")
    begin = F.struct(
        (-mean).alias("log_p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("out")
    )

    def step(s: Column, k: Column) -> Column:
        log_p = s["log_p"] + F.log(mean) - F.log(k.cast("double"))
        total = s["sum"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("sum"), F.concat(s["out"], F.array(total)).alias("out"))

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), last), begin, step, lambda s: s["out"])).otherwise(
        F.array(F.lit(1.0))
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, seed: str = SEED) -> DataFrame:
    """The mixture: rows of ``docs`` by their counts, with ``replica`` and ``shuffle_key``.

    A null source is a source of its own (and the same as an empty one); a null
    id hashes as the empty text.  Equal rows draw equal counts.  Null or empty
    texts are mixed like others; an empty table gives an empty mixture.  Rows
    are ordered by ``shuffle_key`` over all partitions.

    The keys are digests, so equal shares of their range hold equal shares of the
    rows: a partition is told by the first digits, and nothing has to be sampled first.
    """
    spread = replicas(docs, weights, budget, seed)
    width = shuffle_width(docs.sparkSession)
    first = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") / float(2**32)
    return spread.repartitionById(width, F.floor(first * width).cast("int")).sortWithinPartitions("shuffle_key")


def replicas(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, seed: str = SEED) -> DataFrame:
    """``mix`` before the global shuffle."""
    columns = docs.columns
    by_source = rates(docs, weights, budget).select("_source", "steps")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    draw = _unit(F.lit(seed), key)
    # a source with a third of all rows meets its rate in PARTS places
    every = by_source.select("*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    placed = docs.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn("_part", part)
    joined = placed.join(every, ["_source", "_part"])
    counted = joined.select(*columns, F.size(F.filter("steps", lambda p: p <= draw)).alias("_count"))
    copies = counted.where("_count > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("replica"))
    return copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), key, F.col("replica").cast("string"))))
