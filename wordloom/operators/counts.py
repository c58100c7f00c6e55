"""Word counts and vocabulary sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_count(words: DataFrame, min_count: int = 1) -> DataFrame:
    """(word, n). Counts are summed per task before the shuffle, so a hot word costs one row a task."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count) if min_count > 1 else counts


def vocab_size(counts: DataFrame) -> DataFrame:
    """(vocab_size): the number of distinct words of a count table."""
    return counts.agg(F.count(F.lit(1)).alias("vocab_size"))


def vocab_size_by_id_text(counts: DataFrame, id_text: Column) -> DataFrame:
    """(vocab_size) as the length of all id texts together; an empty id list counts 1."""
    length = F.when(id_text == "", 1).otherwise(F.length(id_text))
    return counts.agg(F.coalesce(F.sum(length), F.lit(0)).cast("long").alias("vocab_size"))
