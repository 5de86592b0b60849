"""Catalogue of the queries over texts: ``name -> f(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.abuse import THRESHOLD, abuse_rates, fit_scorer, score_documents
from ledgerfold.llm.lookalike import equal_looking, look_classes
from ledgerfold.llm.markup import clean_markup, find_markup
from ledgerfold.llm.names import cluster_spellings, link_spellings
from ledgerfold.llm.packing import container_usage, document_sizes, pack_documents
from ledgerfold.llm.tokens import encode_corpus
from ledgerfold.operators.packed_values import split_packed

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Registered people and organisations that a row names in another spelling."""
    authors = split_packed(table(spark, folder, "raw_record"), "raw_id", {"authors_raw": ("metadata.authors_raw", "names")})
    typed = authors.select(F.lit("raw_record").alias("origin"), F.col("raw_id").alias("row_id"), F.col("item").alias("name"))
    searched = table(spark, folder, "search_record").select(F.lit("search_record").alias("origin"), F.col("search_id").alias("row_id"), F.explode("authors.name").alias("name"))
    named = typed.unionByName(searched).withColumn("name", F.trim(F.regexp_replace("name", r"\s+", " "))).distinct()
    registry = table(spark, folder, "author_registry")
    meant = link_spellings(named, registry).join(registry.select("person_id", "registered_name"), "person_id").hint("merge")
    alone = F.regexp_replace("name", r",?\s+(?:Jr\.?|Sr\.?|II|III|IV)$", "")
    spelt = F.when(F.col("origin") == "raw_record", alone).otherwise(F.col("name"))
    return named.join(meant, "name").filter(spelt != F.col("registered_name")).select("origin", "row_id", "person_id").distinct()


def p4_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of the names in search records: registered names, spellings, and accepted pairs between them."""
    searched = table(spark, folder, "search_record").select(F.explode("authors.name").alias("name")).withColumn("name", F.trim(F.regexp_replace("name", r"\s+", " ")))
    pairs = cluster_spellings(searched, table(spark, folder, "author_registry"))
    return pairs.groupBy("cluster").agg(F.count_distinct("person_id").alias("n_registered"), F.count_distinct("name").alias("n_spellings"), F.count("*").alias("n_pairs"))


_TEXTS = {"title": "metadata.title", "abstract": "metadata.abstract"}


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of rows whose title or abstract looks the same but is another string."""
    return equal_looking(table(spark, folder, "raw_record"), "raw_id", _TEXTS)


def p5_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of rows whose title or abstract looks the same: a class for each row, and how many strings write it."""
    return look_classes(table(spark, folder, "raw_record"), "raw_id", _TEXTS)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Markup languages of which a title or abstract holds remains."""
    return find_markup(table(spark, folder, "raw_record"), "raw_id", _TEXTS).select("raw_id", "field_name", "markup")


def p7_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Titles and abstracts without markup, with headings, lists, code and formulas kept."""
    return clean_markup(table(spark, folder, "raw_record"), "raw_id", _TEXTS).select("raw_id", "field_name", "text")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return encode_corpus(table(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in a container of each kind, with its place and the tokens it takes."""
    return pack_documents(document_sizes(table(spark, folder, "documents")), table(spark, folder, "pack_capacity"))


def p9_usage(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers of each kind are."""
    return container_usage(p9_containers(spark, folder), table(spark, folder, "pack_capacity"))


def p9_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all three capacities at work: a document for 64 tokens, attention of a quarter of the square."""
    return pack_documents(document_sizes(table(spark, folder, "documents")), table(spark, folder, "pack_capacity"), document_share=1 / 64, attention=0.25)


def p9_bounded_usage(spark: SparkSession, folder: str) -> DataFrame:
    """How full containers of three capacities are."""
    return container_usage(p9_bounded(spark, folder), table(spark, folder, "pack_capacity"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents").select("doc_id", "source", "text"), fit_scorer(table(spark, folder, "abuse_sample")))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text abuses, threatens or demeans, or is sexually explicit."""
    return _scored(spark, folder).filter(F.col("score") >= THRESHOLD).select("doc_id")


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A score for every document."""
    return _scored(spark, folder).select("doc_id", "source", "score")


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of such documents per source."""
    return abuse_rates(_scored(spark, folder))


_ALL = (p4_found, p4_clusters, p5_found, p5_classes, p7_found, p7_clean, p8_ids, p9_containers, p9_usage, p9_bounded, p9_bounded_usage, p10_found, p10_scores, p10_rates)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}
ORACLE: dict[str, str] = {}
