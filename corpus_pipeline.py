"""A corpus from raw documents to a weighted mix, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; ``run`` writes it as Parquet under ``spark.checkpoint.dir`` and reads it back as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import decontam, jaccard_join, mixing, pii_crf, quality_rules
from wordloom.session import stage_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without their failing lines.

    Rows are judged one by one; lines that fail go from the text and ``n_chars`` follows. A null or
    empty text is rejected.
    """
    keys = F.struct(*[F.col(c) for c in COLUMNS]).alias("doc_id")
    judged = quality_rules.quality_rules(docs.select(keys, "text")).where("kept")
    return _with_text(judged.select("doc_id.*", "clean_text"), F.col("clean_text"))


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``row_key`` and ``again``: unlike rows have unlike keys, whatever their doc_id.

    The key is the doc_id where all rows of that id agree, which is the usual case and needs no join. Rows without a doc_id, or
    with one that unlike rows have as well, get a hash of all columns above 2 ** 62, so that they come after the others. ``again``
    marks rows that may have the key of another one, with which they then agree in all columns.
    """
    rows = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("mark"))
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("k"), (F.min("mark") < F.max("mark")).alias("unlike"))
    repeated = stage_table(ids.where("k > 1").select("doc_id", "unlike"), "repeated")
    unlike, again = F.col("doc_id").isNull(), F.col("doc_id").isNull()
    if not repeated.isEmpty():
        rows = rows.join(decontam.small(repeated), "doc_id", "left")
        unlike, again = unlike | F.coalesce("unlike", F.lit(False)), again | F.col("unlike").isNotNull()
    key = F.when(unlike, F.lit(1 << 62) + F.col("mark").bitwiseAND((1 << 61) - 1)).otherwise(F.col("doc_id").cast("bigint"))
    return rows.select(*COLUMNS, key.alias("row_key"), again.alias("again"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the smallest doc_id, once.

    Rows without a doc_id, or with one that unlike rows share, are compared by their own texts and give way to rows of their
    component with an id of their own; of rows that agree in all columns one stays.
    """
    rows = _keyed(docs)
    linked = jaccard_join.jaccard_components(rows.select(F.col("row_key").alias("doc_id"), "text"), width=5, percent=80)
    kept = stage_table(linked.where("doc_id = component_id").select(F.col("doc_id").alias("row_key")).distinct(), "kept")
    left = rows.join(decontam.small(kept), "row_key", "left_semi")
    return left.where(~F.col("again")).select(*COLUMNS).unionByName(left.where("again").dropDuplicates(["row_key"]).select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by its own text, whatever its doc_id."""
    rows = _keyed(docs)
    leaks = decontam.contained_items(rows.select(F.col("row_key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(decontam.small(leaks.select(F.col("doc_id").alias("row_key")).distinct()), "row_key", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    masked = pii_crf.mask_pii(docs.select(*COLUMNS), pii_crf.train(pii_crf.labelled_examples(spark)))
    return _with_text(masked, F.col("text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix holds each document, 0 included; see ``mixing.mix`` for the columns."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("mixing", mixture),
]

#: A random field and subset sums have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
