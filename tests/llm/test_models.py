"""Toxicity and quality: held-out accuracy on the given labels, edge cases, the pipeline's stages."""

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import secret_scan, site_quality, toxicity
from plumbline.llm.queries import QUERIES
from plumbline.llm.tables import table

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    ones = label == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op5_toxicity"](spark, SF).join(table(spark, SF, "labels", "doc_id", "toxic"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert auc(held["score"].to_numpy(), held["toxic"].to_numpy()) > 0.85
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()


def test_toxicity_edge_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = docs((1, None), (2, ""), (None, "idiot"), (3, "word " * 60000), (3, "word " * 60000))
    got = toxicity.scored(odd.withColumn("features", F.lit(1)), none).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.0}
    assert toxicity.scored(docs(), none).count() == 0
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}


def test_features():
    words = toxicity.Words({"idiot": 5.0, "réeux*": 3.0})
    told = dict(zip(toxicity.FEATURES, toxicity.features("You 1d1ot! réeuxvi fine", words), strict=True))
    assert told["hits"] == 2 and told["near_second_person"] == 2 and told["obfuscated_hits"] == 1
    assert toxicity.features("", words) == [0.0] * len(toxicity.FEATURES)


def plain_features(text, lexicon):
    """The features by their definition, word by word."""
    words, n = text.lower().split(), max(1, len(text.split()))
    signs, second = set("#$%&*@~^|<>=+_/\\[]{}"), toxicity.SECOND_PERSON

    def weight(word):
        options = [word] + [word[:k] + "*" for k in range(3, 9) if k <= len(word)]
        return max([lexicon.get(o, 0.0) for o in options]) if word else 0.0

    bare = [w.strip("".join(c for c in w if not c.isalnum())) for w in words]
    odd = [not b.isalpha() and any(b[k - 1].isalnum() and not b[k].isalpha() and any(c.isalnum() for c in b[k + 1 :]) for k in range(1, len(b))) for b in bare]
    read = ["".join(c for c in b.translate(toxicity.LOOKALIKES) if c.isalpha()) for b in bare]
    weights = [int(100 * max(weight(b), weight(r) if o else 0.0)) / 100 for b, r, o in zip(bare, read, odd, strict=True)]
    hits = [k for k, w in enumerate(weights) if w > 0]
    you = [k for k, b in enumerate(bare) if b in second]
    return {
        "hits": len(hits), "hit_density": len(hits) / n, "weight": sum(weights), "top_weight": max(weights, default=0.0),
        "kinds": len({bare[k] for k in hits}), "near_second_person": sum(any(abs(k - y) <= 4 for y in you) for k in hits),
        "second_person_rate": len(you) / n, "exclamations": text.count("!") / n, "symbols": sum(c in signs for c in text) / n,
        "obfuscated": sum(odd) / n, "obfuscated_hits": sum(odd[k] for k in hits),
    }


def test_features_are_those_of_a_plain_version():
    random = np.random.default_rng(2)
    lexicon = {"idiot": 5.0, "scum": 3.25, "réeux*": 3.0, "vil*": 2.5}
    pool = ["You", "your", "idiot!", "1d1ot", "id!ot", "SCUM", "vile", "villain", "réeuxvi", "plain", "it's", "x_y", "42", "a=b", "!!!", "Tu", "sc-um", "s¢um"]
    for _ in range(200):
        text = " ".join(random.choice(pool, random.integers(1, 40)))
        told = dict(zip(toxicity.FEATURES, toxicity.features(text, toxicity.Words(lexicon)), strict=True))
        for name, value in plain_features(text, lexicon).items():
            assert abs(told[name] - value) < 1e-9, (text, name)


def test_quality_on_held_out_rows(spark):
    got = QUERIES["op8_site_quality"](spark, SF).join(table(spark, SF, "labels", "doc_id", "quality"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.95
    assert held[held["quality"] == 1]["keep"].mean() > 0.97


def test_places_shrink_to_the_level_above(spark, docs):
    rows = [(i, "text", "en", "good" if i % 2 else "bad", 4) for i in range(400)] + [(1000, "text", "de", "good", 4)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1000, 0)], "doc_id long, quality int")
    got = {(r["host"], r["path"]): r for r in site_quality.places(docs(*rows).select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path")), labels).collect()}
    assert got["good", "en"]["host_share"] > 0.9 > 0.1 > got["bad", "en"]["host_share"]
    if ("good", "de") in got:  # one label of its own hardly moves it from its host
        assert got["good", "de"]["path_share"] < got["good", "de"]["host_share"]


def strength(good, n, p):
    """Pseudo-counts by moments, over groups of ``good`` out of ``n`` labels below shares ``p``."""
    within = (((good - n * p) ** 2 / (p * (1 - p)) - n).sum()) / (n * (n - 1)).sum()
    return min(max(1 / within - 1 if within > 0 else 1000.0, 2.0), 1000.0)


def test_posteriors_are_those_of_plain_numpy(spark, docs):
    """Hosts and paths from one label to hundreds, computed by loops over all labelled rows."""
    random = np.random.default_rng(4)
    hosts = random.choice(60, 3000, p=np.arange(60, 0, -1) / 1830)
    paths = random.integers(0, 4, 3000)
    good = random.random(3000) < np.clip(0.5 + 0.4 * np.sin(hosts) + 0.1 * np.cos(hosts * 4 + paths), 0.02, 0.98)
    rows = [(i, "text", f"p{paths[i]}", f"h{hosts[i]}", 4) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(good[i])) for i in range(3000)], "doc_id long, quality int")
    frame = docs(*rows).select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"))
    got = {(r["host"], r["path"]): r for r in site_quality.places(frame, labels).collect()}
    sums = {}
    for i in range(3000):
        if crc32(str(i).encode()) % 4 != 2:
            for key in ((f"h{hosts[i]}", f"p{paths[i]}"), (f"h{hosts[i]}", None)):
                g, n = sums.get(key, (0, 0))
                sums[key] = g + int(good[i]), n + 1
    by_host = {h: v for (h, p), v in sums.items() if p is None}
    by_path = {k: v for k, v in sums.items() if k[1] is not None}
    g, n = (np.array(c, float) for c in zip(*by_host.values(), strict=True))
    prior = (g.sum() + 1) / (n.sum() + 2)
    a = strength(g, n, np.full(len(g), prior))
    host_share = {h: (v[0] + a * prior) / (v[1] + a) for h, v in by_host.items()}
    above = np.array([host_share[h] for h, _ in by_path])
    g, n = (np.array(c, float) for c in zip(*by_path.values(), strict=True))
    b = strength(g, n, above)
    assert 2.0 < a < 1000.0 and set(got) == set(by_path)
    for (key, (good_, n_)), host in zip(by_path.items(), above, strict=True):
        r = got[key]
        assert abs(r["prior"] - prior) < 1e-12 and abs(r["host_share"] - host) < 1e-9
        assert abs(r["path_share"] - (good_ + b * host) / (n_ + b)) < 1e-9
    few = min(by_host, key=lambda h: by_host[h][1])
    own = by_host[few][0] / by_host[few][1]
    assert min(own, prior) <= host_share[few] <= max(own, prior)  # between its own labels and the corpus


def test_quality_edge_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = docs((1, None), (2, "", None, None, None), (None, "x"), (3, "a | b " * 40000), (3, "a | b " * 40000))
    got = site_quality.scored(odd.withColumn("host", F.lit(1)).withColumn("part", F.lit(1)), none).collect()
    assert len(got) == 5 and {round(r["score"], 9) for r in got} == {0.5}
    assert site_quality.scored(docs(), none).count() == 0


def test_few_labels_of_a_kind_still_order_documents(spark, docs):
    rows = [(i, f"you {'vile idiot scum ' if i % 40 == 0 else 'kind gentle words '}{i} " * 6) for i in range(400)]
    learnt = [i for i in range(0, 400, 40) if crc32(str(i).encode()) % 4 != 2][:3]
    told = spark.createDataFrame([(i, int(i % 40 == 0)) for i, _ in rows if i % 40 or i in learnt], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(*rows), told).collect()}
    bad = [s for i, s in got.items() if i % 40 == 0]
    assert min(bad) > max(s for i, s in got.items() if i % 40)
    kept = {r["doc_id"] for r in toxicity.clean(docs(*rows), told).collect()}
    assert kept == {i for i, _ in rows if i % 40}


def test_without_labels_of_both_kinds_nothing_is_rejected(spark, docs):
    rows = [(i, f"words {i}") for i in range(30)]
    for label in (0, 1):
        told = spark.createDataFrame([(i, label) for i, _ in rows], "doc_id long, toxic int")
        assert toxicity.clean(docs(*rows), told).count() == 30
    assert toxicity.clean(docs(*rows).withColumn("features", F.lit(1)).withColumn("row", F.lit(2)), told).columns[-2:] == ["features", "row"]


@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        docs = spark.createDataFrame(made.toArrow(), made.schema)
        out[name] = docs.toPandas()
    return out


def test_stages_follow_their_operators(spark, staged):
    docs = staged["documents"]
    toxic = toxicity.scored(table(spark, SF, "documents", "doc_id", "text"), table(spark, SF, "labels", "doc_id", "toxic")).toPandas()
    stay = set(toxic[toxic["predicted"] == 0]["doc_id"])
    assert set(staged["toxicity"]["doc_id"]) == stay
    from test_ngram_join import brute_force

    left = docs[docs["doc_id"].isin(stay)]
    first = {c if n else d for d, n, c in brute_force(list(zip(left["doc_id"], left["text"], strict=True)))}
    assert sorted(staged["ngram_join"]["doc_id"]) == sorted(first)
    masked = staged["secret_scan"].set_index("doc_id")
    spans = secret_scan.scan(spark.createDataFrame(left)).select("doc_id", F.size("secret_spans").alias("n")).toPandas().set_index("doc_id")["n"]
    text = docs.set_index("doc_id")["text"]
    for doc_id, row in masked.iterrows():
        assert (row["text"] == text[doc_id]) == (spans[doc_id] == 0)
        assert row["n_chars"] == len(row["text"])
    assert set(staged["mixing"]["doc_id"]) <= set(masked.index)
    counts = staged["mixing"]["doc_id"].value_counts()
    packed = staged["packing"].groupby("doc_id")["start"].apply(lambda s: (s == 0).sum())
    assert packed.to_dict() == counts.to_dict()


def test_all_stages_but_the_last_keep_the_columns(staged):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert list(staged[name].columns) == list(corpus_pipeline.COLUMNS)


def test_one_text_of_each_component_stays(spark, docs):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(5, a), (7, a + " end"), (7, b), (8, c), (8, d), (8, d), (None, d), (None, "z " + d[::-1]), (None, "z " + d[::-1]), (9, None), (None, ""), (None, "")]
    got = corpus_pipeline.drop_near_copies(spark, docs(*rows), SF).select("doc_id", "text").collect()
    expected = [(5, a), (7, b), (8, c), (8, d), (None, "z " + d[::-1]), (9, None), (None, ""), (None, "")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_stages_take_empty_and_odd_tables(spark, docs):
    from corpus_pipeline import STAGES

    for frame in (docs(), docs((1, None), (None, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "secret=abcdefgh"))):
        now = frame.withColumn("root", F.lit(1))
        for _, stage in STAGES:
            now = stage(spark, now, SF)
            now.collect()
