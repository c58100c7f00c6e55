"""Byte-pair encoding with a rank table given by the user.

Encoding needs nothing but the rank table, whose size does not grow with the corpus, so it is a
map-only step: an Arrow UDF over whole batches with the table broadcast. Each distinct word of a
batch is encoded once, and a task remembers the words of its earlier batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns that cut a word into pieces before merging. WORDS_100K belongs to the
# public 100k-entry rank table, WORDS_50K to the public 50k-entry ones.
WORDS_100K = (
    r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}|"
    r" ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
)
WORDS_50K = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Most entries and bytes a rank table may have to be broadcast; public tables have 50,000 to
#: 200,000 entries and about a megabyte.
MAX_RANKS = 1_000_000
MAX_RANK_BYTES = 64 << 20
#: Distinct words a task remembers, and the longest of them.
MEMORY, LONGEST = 1 << 18, 64


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(token_id, token_bytes) from a text file with a base64 token and its rank per line."""
    fields = F.split("value", " ")
    return (
        spark.read.text(path)
        .where("value <> ''")
        .select(F.get(fields, F.lit(1)).cast("int").alias("token_id"), F.unbase64(F.get(fields, F.lit(0))).alias("token_bytes"))
    )


def byte_ranks(spark: SparkSession) -> DataFrame:
    """The table without merges: every byte is its own token."""
    return spark.range(256).select(
        F.col("id").cast("int").alias("token_id"), F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token_bytes")
    )


class Encoder:
    """Column functions for one rank table; ``pattern`` cuts words before merging."""

    def __init__(self, ranks: DataFrame, pattern: str = WORDS_100K):
        spark = ranks.sparkSession
        size = ranks.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token_bytes")).alias("bytes")).first()
        if size.n > MAX_RANKS or (size.bytes or 0) > MAX_RANK_BYTES:
            raise ValueError(f"a rank table has at most {MAX_RANKS} entries and {MAX_RANK_BYTES} bytes")
        rows = ranks.collect()
        self.ranks = ranks
        self._table = spark.sparkContext.broadcast({bytes(r.token_bytes): r.token_id for r in rows})
        self._pattern = pattern
        self.size = len(rows)

    def word_ids(self, word: Column) -> Column:
        """ARRAY<INT> of one word; the empty word has none."""
        return self._udf(per_sentence=False)(word)

    def sentence_ids(self, sentence: Column) -> Column:
        """ARRAY<INT> of all words of a sentence, each encoded by itself without its space."""
        return self._udf(per_sentence=True)(sentence)

    def sentence_token_ids(self, sentences: DataFrame) -> DataFrame:
        """(keys, token_ids) without a shuffle; sentences without words give no row."""
        keys = [c for c in sentences.columns if c != "sentence"]
        worded = sentences.where(F.rtrim("sentence") != "")
        return worded.select(*keys, self.sentence_ids(F.col("sentence")).alias("token_ids"))

    def decode(self, ids: DataFrame) -> DataFrame:
        """(token_id, token): the bytes of each distinct id as text, broken UTF-8 replaced."""
        text = F.make_valid_utf8(F.col("token_bytes").cast("string"))
        names = self.ranks.select("token_id", text.alias("token"))
        return ids.select("token_id").distinct().join(F.broadcast(names), "token_id")

    def _udf(self, per_sentence: bool):
        table, pattern, memory = self._table, self._pattern, MEMORY

        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import numpy as np
            import pyarrow.compute as pc
            import tiktoken

            codec = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table.value, special_tokens={})
            remembered = lru_cache(memory)(codec.encode_ordinary)
            for batch in batches:
                texts = pc.fill_null(batch, "")
                if per_sentence:
                    lists = pc.split_pattern(texts, " ")
                    words, row_ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists))])
                else:
                    words, row_ends = texts, np.arange(len(texts) + 1)
                # Only the distinct words of the batch are encoded; their ids are then laid out by place.
                coded = words.dictionary_encode()
                which = coded.indices.to_numpy(zero_copy_only=False)
                ids = [remembered(w) if len(w) <= LONGEST else codec.encode_ordinary(w) for w in coded.dictionary.to_pylist()]
                size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=size.sum())
                begin = (np.cumsum(size) - size)[which]
                length = size[which]
                ends = np.concatenate([[0], np.cumsum(length)])
                take = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], length)
                yield pa.ListArray.from_arrays(pa.array(ends[row_ends].astype(np.int32)), pa.array(flat[take]))

        return F.arrow_udf(encode, "array<int>")
