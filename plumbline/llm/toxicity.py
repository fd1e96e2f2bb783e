"""Toxicity of documents: gradient-boosted trees over dense features, isotonic calibration.

A lexicon of words and word beginnings is learnt from labelled rows.  Features
are lexicon densities, hits close to the second person, capitals, punctuation,
and rates of obfuscated spelling; trees are boosted on them, and an isotonic
regression on rows the trees have not seen turns their output into a probability.
Labels, language, source and id are no features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.ngram_join import Shingler
from plumbline.llm.tables import kept, small_batches

#: labelled rows that models are fitted on, by the smallest hashes of their ids
TRAIN_ROWS = 8000
#: of the fitted rows, one in so many is kept for the calibration
CALIBRATION = 4
#: a lexicon entry is in this share of toxic rows at least, and that often right
LEXICON_SHARE, LEXICON_LEAST, LEXICON_RIGHT, LEXICON_SIZE = 0.01, 4, 0.9, 4000
BEGINNINGS = range(3, 9)
REJECT = 0.3
#: share of the uncalibrated output in a score, which orders rows of one calibrated step
FINE = 0.02

#: fixed words: the second person in the languages of the corpus
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes tus".split()
)
#: fixed table: signs that stand for letters
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")

FEATURES = (
    "log_words", "hits", "hit_density", "weight", "weight_density", "top_weight", "kinds", "near_second_person",
    "second_person_rate", "capitals", "shouted", "punctuation", "exclamations", "symbols", "obfuscated", "obfuscated_hits",
)

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W_][\W\d_]+[^\W_]")
_KINDS = np.zeros(256, np.uint8)
_KINDS[65:91] = 1  # capitals
_KINDS[97:123] = 2
_KINDS[128:] = 2
_KINDS[[ord(c) for c in ".,;:'\"()-?"]] = 3
_KINDS[ord("!")] = 4
_KINDS[[ord(c) for c in "#$%&*@~^|<>=+_/\\[]{}"]] = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; rows of fold 2 are never learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def plain(word: str) -> str:
    """A lower-case word without signs at its edges."""
    return _EDGE.sub("", word)


def spelled(word: str) -> str:
    """The letters that an obfuscated word stands for."""
    return "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())


def entries(word: str) -> list[str]:
    """The word itself and its beginnings, those with a star."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if n <= len(word)]]


class Words(dict):
    """Code of each word met: 0 for most; bit 0 second person, bit 1 obfuscated, above that a lexicon weight in hundredths."""

    MEMORY = 400_000

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def _weight(self, word: str) -> float:
        return max(map(self.lexicon.get, entries(word), [0.0] * 99)) if word else 0.0

    def __missing__(self, raw: str) -> int:
        if len(self) > self.MEMORY:
            self.clear()
        word = plain(raw)
        weight, odd = self._weight(word), 0
        if not word.isalpha() and _INNER.search(word):
            odd = 2
            weight = max(weight, self._weight(spelled(word)))
        code = (int(100 * weight) << 2) | odd | (word in SECOND_PERSON)
        self[raw] = code
        return code


def features(text: str, words: Words) -> list[float]:
    """``FEATURES`` of a whole text; all are 0 without words."""
    parts = text.lower().split()
    if not parts:
        return [0.0] * len(FEATURES)
    codes = list(map(words.__getitem__, parts))
    n = len(parts)
    marked = {k: c for k, c in enumerate(codes) if c} if any(codes) else {}
    hits = [k for k, c in marked.items() if c > 3]
    second = [k for k, c in marked.items() if c & 1]
    weights = [(marked[k] >> 2) / 100 for k in hits]
    around = set(second)
    near = sum(any(k + d in around for d in range(-4, 5)) for k in hits) if around else 0
    odd = sum(1 for c in marked.values() if c & 2)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_KINDS[data], minlength=6)
    letters = max(1, int(kinds[1] + kinds[2]))
    shouted = sum(1 for w in text.split() if w.isupper() and len(w) > 2) if kinds[1] > 0.1 * letters else 0
    return [
        log1p(n), float(min(len(hits), 50)), len(hits) / n, float(sum(weights)), sum(weights) / n, max(weights, default=0.0),
        float(len({plain(parts[k]) for k in hits})), float(near), len(second) / n, kinds[1] / letters, shouted / n,
        kinds[3] / n, kinds[4] / n, kinds[5] / n, odd / n, float(sum(1 for k in hits if marked[k] & 2)),
    ]


def featured(docs: DataFrame, lexicon: dict[str, float], *passed: str) -> DataFrame:
    """The columns ``passed`` and ``features`` (array of doubles) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = ", ".join([f"{c} {docs.schema[c].dataType.simpleString()}" for c in passed] + ["features array<double>"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for batch in batches:
            found = [features(t.as_py() or "", words) for t in batch["text"]]
            columns = [batch[c] for c in passed] + [pa.array(found, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, names=[*passed, "features"])

    return docs.select(*dict.fromkeys([*passed, "text"])).mapInArrow(rows, schema)


def with_features(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """All columns of every row and ``features``; the text goes to Python one way, nothing else does."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("array<double>")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(shared.value)
        for some in texts:
            yield pa.array([features(t.as_py() or "", words) for t in some], pa.list_(pa.float64()))

    return docs.withColumn("features", found("text"))


# ------------------------------------------------------------------ fitting


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled rows outside the held-out fold: doc_id, text, label, calibrate, shingle.

    Rows go by the smallest hashes of their ids.  A doc labelled more than once
    has its largest label; of rows whose smallest shingle is the same, which
    are mostly copies, one is taken.
    """
    usable = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    once = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    some = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # the bound on rows is the bound on what is broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            sets = [shingle(t.as_py() or "") for t in batch["text"]]
            least = pa.array([int(s[0] >> np.uint64(1)) if len(s) else -1 for s in sets], pa.int64())
            yield pa.record_batch([*batch.columns, least], names=[*batch.schema.names, "shingle"])

    found = texts.mapInArrow(marked, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, label int, shingle long")
    first = found.groupBy("shingle").agg(F.min_by(F.struct("doc_id", "text", "label"), F.struct("doc_id", "label")).alias("r"))
    return first.select("r.*").withColumn("calibrate", F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATION)) == 0)


def learnt_lexicon(rows: DataFrame) -> dict[str, float]:
    """Words and beginnings that mark label 1, with their log odds; at most ``LEXICON_SIZE``.

    Entries are counted once for each row, in two passes: those of rows with
    label 1, then how often the frequent ones are in other rows.
    """

    def counted(keep=None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter = Counter()
            for batch in batches:
                for text in batch["text"]:
                    met = {e for w in set(map(plain, (text.as_py() or "").lower().split())) if w.isalpha() for e in entries(w)}
                    total.update(met if keep is None else met & keep.value)
            yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["entry", "n"])

        return run

    fit = rows.where("not calibrate").select("text", "label")
    sizes = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones:
        return {}
    least = min(max(LEXICON_LEAST, LEXICON_SHARE * ones), ones)
    of_ones = fit.where("label = 1").select("text").mapInArrow(counted(), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    frequent = of_ones.where(F.col("n") >= least).orderBy(F.desc("n"), "entry").limit(10 * LEXICON_SIZE).collect()
    keep = rows.sparkSession.sparkContext.broadcast({r["entry"] for r in frequent})
    of_zeros = fit.where("label = 0").select("text").mapInArrow(counted(keep), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    other = {r["entry"]: r["n"] for r in of_zeros.collect()}
    found = {}
    for r in frequent:
        a, b = r["n"] / ones, other.get(r["entry"], 0) / max(1, zeros)
        if a / (a + b) >= LEXICON_RIGHT:
            found[r["entry"]] = min(9.0, log((r["n"] + 0.5) / (ones + 1)) - log((other.get(r["entry"], 0) + 0.5) / (zeros + 1)))
    return dict(list(found.items())[:LEXICON_SIZE])


@dataclass
class Model:
    """A lexicon, trees and calibration; without labels of both kinds only the share of label 1 that was seen."""

    lexicon: dict[str, float]
    trees: object = None
    steps: object = None
    share: float = 0.0

    def score(self, docs: DataFrame, *passed: str) -> DataFrame:
        """The columns ``passed`` and ``score`` of every row."""
        if self.trees is None:
            return docs.select(*passed, F.lit(self.share).alias("score"))
        return self._scored(featured(docs, self.lexicon, *passed), *passed)

    def _scored(self, rows: DataFrame, *passed: str) -> DataFrame:
        told = self.trees.transform(rows.withColumn("features", array_to_vector("features")))
        raw = told.select(*passed, vector_to_array("probability")[1].alias("raw"))
        told = self.steps.transform(raw)
        score = (1 - FINE) * F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)) + FINE * F.col("raw")
        return told.select(*passed, score.alias("score"))

    def score_beside(self, docs: DataFrame) -> DataFrame:
        """All columns of every row in ``row``, and ``score``."""
        whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
        if self.trees is None:
            return whole.select("row", F.lit(self.share).alias("score"))
        return self._scored(with_features(whole, self.lexicon).drop("text"), "row")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    rows = kept(labelled(docs, labels, label), "labelled")
    shares = {(r["calibrate"], r["label"]) for r in rows.select("calibrate", "label").distinct().collect()}
    if not {0, 1} <= {kind for _, kind in shares}:
        return Model({}, share=rows.agg(F.avg("label")).first()[0] or 0.0)
    if not {(False, 0), (False, 1), (True, 0), (True, 1)} <= shares:
        # too few of a label for both parts: the trees are fitted and calibrated on all rows
        rows = rows.withColumn("calibrate", F.explode(F.array(F.lit(False), F.lit(True))))
    lexicon = learnt_lexicon(rows)
    small = kept(featured(rows, lexicon, "label", "calibrate").coalesce(4), "features")
    ready = small.withColumn("features", array_to_vector("features")).cache()
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=1, checkpointInterval=-1
    ).fit(ready.where("not calibrate"))
    told = trees.transform(ready.where("calibrate")).select("label", vector_to_array("probability")[1].alias("raw"))
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(told.withColumn("label", F.col("label").cast("double")))
    ready.unpersist()
    return Model(lexicon, trees, steps)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts have all features 0 and the score that belongs to
    them; repeated rows repeat their score.  A null id is in no held-out fold
    and never learnt from.  An empty table gives no rows.  Where a label has too few
    rows for two parts, the calibration uses the rows of the fit; without labels of
    both kinds every score is the share of toxic rows seen, or 0.
    """
    model = fit(docs, labels)
    told = model.score(docs.select(F.col("doc_id"), "text"), "doc_id")
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Where no model can be fitted, because labels of a kind are missing, nothing is
    known of any row and all stay.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, labels)
    if model.trees is None:
        return docs
    return model.score_beside(docs).where(F.col("score") < REJECT).select("row.*")
