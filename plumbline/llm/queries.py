"""The registered queries of the dealt operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import html_text, mixing, near_vectors, neighbours, ngram_join, packing, prefix_trie, ranked_search, secret_scan, vector_packing, warc
from plumbline.llm.tables import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text")))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import site_quality  # with it comes the ML library, which other queries leave out of the driver

    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return site_quality.scored(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id % 100 = 0", 10)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    # the names of archives differ from run to run
    return index.drop("archive", "place", "url", "url_key")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumbline.llm import toxicity

    return toxicity.scored(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the digests of the sequences; their ids stay with ``packing.sequences``
    return packing.places(packing.sequences(table(spark, sf_dir, "documents", "doc_id", "text")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.places(vector_packing.sequences(table(spark, sf_dir, "documents", "doc_id", "text")))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_html_text": op2_html_text,
    "op3_ngram_join": op3_ngram_join,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_near_vectors": op7_near_vectors,
    "op8_site_quality": op8_site_quality,
    "op9_neighbours": op9_neighbours,
    "op10_mixing": op10_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_packing": op13_vector_packing,
}
