"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    decontam,
    html_extract,
    importance,
    jaccard_join,
    lang_id,
    licences,
    lm_bloom,
    mixing,
    pii_crf,
    prefix_trie,
    quality_rules,
    url_filter,
    warc,
)
from wordloom.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs that a rule decides are the labelled ones."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path("url")
    labelled = pages.select("url", (url_filter.rule_of(host, path)["verdict"] == "block").alias("blocked"))
    return url_filter.judge(pages, url_filter.train(labelled))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lang_id.held_out("doc_id", 4, 2)
    found = lang_id.predict(docs, lang_id.prototypes(docs.where(~out).select("lang", "text")))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def op5_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lang_id.held_out("doc_id", 7, 2)
    found = lm_bloom.scores(table(spark, sf_dir, "documents"), ~out)
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pii_crf.train(pii_crf.labelled_examples(spark))
    rows = pii_crf.find_pii(table(spark, sf_dir, "documents"), model)
    base = F.filter("spans", lambda s: s.base)
    of_kind = F.transform(base, lambda s: s.kind)
    counts = [(F.size(base) - F.size(F.array_remove(of_kind, kind))).cast("long").alias(f"n_{kind}") for kind in pii_crf.KINDS]
    return rows.select("doc_id", *counts, F.sha2(pii_crf.digest(base), 256).alias("base_sha256"), pii_crf.digest(F.col("spans")).alias("spans"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write(table(spark, sf_dir, "pages"), target)
    return warc.read(manifest, target).drop("url")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("repeats")


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extract": op2_html_extract,
    "op3_lang_id": op3_lang_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_bloom": op5_lm_bloom,
    "op6_pii": op6_pii,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_decontam": op10_decontam,
    "op11_licences": op11_licences,
    "op12_importance": op12_importance,
    "op13_prefix_trie": op13_prefix_trie,
}
