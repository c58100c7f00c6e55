"""From texts to lines, words and sentences. Every step is map-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as T

DOC = ("doc_id",)


def to_lines(docs: DataFrame, keys: tuple[str, ...] = DOC, text: str = "text") -> DataFrame:
    """(keys, line_no, line)"""
    return docs.select(*keys, F.posexplode(T.split_lines(F.col(text))).alias("line_no", "line"))


def to_words(lines: DataFrame, drop_empty: bool = False) -> DataFrame:
    """(keys, word_idx, word): every word of every line, blank lines giving one empty word."""
    keys = [c for c in lines.columns if c != "line"]
    words = lines.select(*keys, F.posexplode(T.split_words(F.col("line"))).alias("word_idx", "word"))
    return words.where("word <> ''") if drop_empty else words


def to_sentences(lines: DataFrame, pattern: str = T.SENTENCE_BREAK) -> DataFrame:
    """(keys, sentence_idx, sentence)"""
    keys = [c for c in lines.columns if c != "line"]
    # A column of its own lets Spark split each line once; inside the generator it would split per use.
    parts = lines.select(*keys, T.split_pattern(F.col("line"), pattern).alias("parts"))
    return parts.select(*keys, F.posexplode("parts").alias("sentence_idx", "sentence"))


def sentence_extent(lines: DataFrame, pattern: str = T.SENTENCE_BREAK) -> DataFrame:
    """(keys, n_sentences, max_idx) per line, from the array itself instead of a grouping."""
    keys = [c for c in lines.columns if c != "line"]
    n = F.size(T.split_pattern(F.col("line"), pattern))
    return lines.select(*keys, n.alias("n_sentences")).withColumn("max_idx", F.col("n_sentences") - 1)


def without_tokens(sentences: DataFrame) -> DataFrame:
    """Sentences that hold no word, and so give no sample."""
    return sentences.where(F.rtrim("sentence") == "")


def to_tokens(sentences: DataFrame) -> DataFrame:
    """(keys, tok_idx, word): the words to encode. Empty words encode to nothing and are left out."""
    keys = [c for c in sentences.columns if c != "sentence"]
    return sentences.select(
        *keys, F.posexplode(T.split_words(F.col("sentence"))).alias("tok_idx", "word")
    ).where("word <> ''")
