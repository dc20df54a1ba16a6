"""Registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, conversation_trie, decontaminate, language_id, learn, line_dedup, ngram_join, packing, quality_fm, quality_rules, secret_scan, sharding, toxicity, url_filter
from .oracles import ORACLE
from .tables import read


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.fit(url_filter.labelled_urls(pages)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.fit(docs, labels))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = quality_fm.score(docs, quality_fm.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(learn.fold() == learn.HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secret_scan.scan(docs, (*secret_scan.WORDS, *secret_scan.corpus_words(docs)))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", F.coalesce(learn.fold() == learn.HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read(spark, sf_dir, "conversations")).drop("a", "b", "pa", "pb")


__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_toxicity, op3_url_filter, op4_packing, op5_quality_rules, op6_quality_classifier,
        op7_secret_scans, op8_ngram_jaccard_join, op9_line_dedup, op10_benchmark_decontamination, op11_language_id, op12_phrase_collocations, op13_conversation_trie)}
