"""Quality of documents by hierarchical empirical Bayes.

A document classifier gives each text its own evidence.  Labels of a host and of
a path below it say how good such places are; their posteriors shrink towards
the level above, the more the fewer labels they have, with strengths estimated
from all labelled rows by grouped sums.  A document's score adds what its place
says, relative to the corpus, to the evidence of its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import kept
from plumbline.llm.toxicity import held_out, labelled

#: a document is kept from this score on
KEEP = 0.5
#: bounds of the pseudo-counts by which a place is shrunk, and of a share
STRENGTH = (2.0, 1000.0)
SMALLEST = 0.01
#: places are dealt to so many parts before they meet, so no place is one task's
PARTS = 32

FEATURES = (
    "log_words", "word_length", "distinct", "repeats", "symbols", "digits", "capitals", "punctuation", "bars", "line_words",
    "repeated_lines", "sentence_words", "marks", "long_words", "top_word",
)


def evidence(text: str) -> list[float]:
    """``FEATURES`` of a whole text; all are 0 without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    chars = int(data.sum())
    of = lambda s: int(data[list(s.encode())].sum())
    _, counts = np.unique(np.array([hash(w) for w in words], np.int64), return_counts=True)
    lines = [line for line in text.split("\n") if line.strip()]
    stops = of(".?!")
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        log1p(n), chars / n, len(counts) / n, same / n, of("#$%&*@~^<>=+_/\\[]{}") / n, of("0123456789") / chars,
        int(data[65:91].sum()) / chars, of(".,;:") / n, of("|") / n, log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), log1p(n / (stops + 1)), of("!") / n, sum(len(w) > 20 for w in words) / n, int(counts.max()) / n,
    ]


def featured(docs: DataFrame, *passed: str) -> DataFrame:
    schema = ", ".join([f"{c} {docs.schema[c].dataType.simpleString()}" for c in passed] + ["features array<double>"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [evidence(t.as_py() or "") for t in batch["text"]]
            yield pa.record_batch([*[batch[c] for c in passed], pa.array(found, pa.list_(pa.float64()))], names=[*passed, "features"])

    return docs.select(*dict.fromkeys([*passed, "text"])).mapInArrow(rows, schema).withColumn("features", array_to_vector("features"))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(SMALLEST)), F.lit(1 - SMALLEST))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, good: str, n: str, parent: str | float) -> float:
    """Pseudo-counts of the prior below ``parent``, by moments over all groups.

    With k groups the spread of their shares beyond what ``n`` labels give by
    chance is the prior's own; where there is none, places are all alike.
    """
    p = F.col(parent) if isinstance(parent, str) else F.lit(parent)
    row = groups.agg(
        F.sum((F.col(good) - F.col(n) * p) ** 2 / F.greatest(p * (1 - p), F.lit(1e-6)) - F.col(n)).alias("beyond"),
        F.sum(F.col(n) * (F.col(n) - 1)).alias("pairs"),
    ).first()
    within = (row["beyond"] or 0.0) / row["pairs"] if row["pairs"] else 0.0
    return float(min(max(1 / within - 1 if within > 0 else STRENGTH[1], STRENGTH[0]), STRENGTH[1]))


def places(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Posterior shares of every labelled place: host, path, host_share, path_share, and the corpus share as ``prior``.

    All labelled rows outside the held-out fold count.  They are summed by path,
    then by host, so a host with a third of all rows is a few sums per task.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("good")).where("doc_id is not null and good is not null")
    once = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("good").alias("good"))
    rows = docs.select("doc_id", "host", "path").join(once, "doc_id")
    by_path = kept(rows.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "paths")
    by_host = by_path.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    all_ = by_host.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    prior = (all_["good"] + 1) / (all_["n"] + 2) if all_["n"] else 0.5
    a = _strength(by_host, "good", "n", prior)
    hosts = by_host.select("host", ((F.col("good") + a * prior) / (F.col("n") + a)).alias("host_share"))
    joined = by_path.join(hosts, "host")
    b = _strength(joined, "good", "n", "host_share")
    path_share = (F.col("good") + b * F.col("host_share")) / (F.col("n") + b)
    return joined.select("host", "path", "host_share", path_share.alias("path_share"), F.lit(prior).alias("prior"))


def scored(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, text_score, host_share, path_share, score, keep.

    ``host`` and ``path`` default to the source and to the language in it; a
    null one is a place of its own.  A path without labels has the share of its
    host, a host without labels that of the corpus.  Null and empty texts have
    the evidence of no words.  Repeated rows repeat their scores, an empty table
    gives no rows, and without labels of both kinds texts say nothing.
    """
    host = F.coalesce(F.col("source").cast("string"), F.lit("")) if host is None else F.coalesce(host, F.lit(""))
    path = F.coalesce(F.col("lang").cast("string"), F.lit("")) if path is None else F.coalesce(path, F.lit(""))
    sited = docs.select("doc_id", "text", host.alias("host"), path.alias("path"))
    rows = kept(labelled(sited.select("doc_id", "text"), labels, "quality"), "labelled")
    told = featured(sited, "doc_id", "host", "path")
    if {r["label"] for r in rows.select("label").distinct().collect()} >= {0, 1}:
        fit = LogisticRegression(regParam=0.002, maxIter=60, standardization=True).fit(featured(rows, "label"))
        fit.setFeaturesCol("features").setProbabilityCol("probability")
        told = fit.transform(told).withColumn("text_score", vector_to_array("probability")[1])
    else:
        told = told.withColumn("text_score", F.lit(0.5))
    told = told.select("doc_id", "host", "path", "text_score")

    known = places(sited, labels)
    by_host = known.groupBy("host").agg(F.max("host_share").alias("host_share"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part")
    dealt = told.withColumn("part", part.cast("long"))
    prior = known.select("prior").first()
    prior = prior[0] if prior else 0.5
    dealt = dealt.join(by_host.select("*", every), ["host", "part"], "left").join(
        known.select("host", "path", "path_share", every), ["host", "path", "part"], "left"
    )
    host_share = F.coalesce("host_share", F.lit(prior))
    path_share = F.coalesce("path_share", host_share)
    logit = _logit(F.col("text_score")) + _logit(path_share) - _logit(F.lit(prior))
    score = 1 / (1 + F.exp(-logit))
    return dealt.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "text_score",
        host_share.alias("host_share"),
        path_share.alias("path_share"),
        score.alias("score"),
        (score >= KEEP).alias("keep"),
    )
