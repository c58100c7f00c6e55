"""Dictionary encoding: one id per distinct word, by falling count."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.counts import word_count
from wordloom.operators.ranking import with_position
from wordloom.session import stage_table

#: Most bytes of dictionary a join may broadcast.
HOT_BYTES = 64 << 20
#: Bytes a broadcast row takes beside the word itself: row header, id, hash table slot.
ROW_BYTES = 64

ID_BITS = 32
ID_MASK = (1 << ID_BITS) - 1


def count_with_ids(words: DataFrame) -> DataFrame:
    """(word, n, token_id): ids from 1 by falling count, then word; the empty word has none.

    0 stays free for padding.
    """
    blank = F.col("word") == ""
    ranked = with_position(word_count(words), [blank, F.desc("n"), F.asc("word")], "token_id")
    return ranked.withColumn("token_id", F.when(~blank, F.col("token_id")).cast("int"))


def build_dictionary(words: DataFrame) -> DataFrame:
    """(word, n, token_id) of all words but the empty one."""
    return count_with_ids(words.where("word <> ''"))


def hot_limit(dictionary: DataFrame, max_bytes: int = HOT_BYTES) -> int | None:
    """The largest power of two so that all ids below it fit in ``max_bytes``; None if all ids do.

    One row per power of two reaches the driver.
    """
    power = F.floor(F.log2("token_id")).cast("int").alias("power")
    sizes = dictionary.groupBy(power).agg(F.sum(F.octet_length("word") + ROW_BYTES)).collect()
    total = 0
    for power, size in sorted(sizes):
        total += size
        if total > max_bytes:
            return 1 << power
    return None


def look_up(tokens: DataFrame, dictionary: DataFrame, max_bytes: int = HOT_BYTES) -> DataFrame:
    """Add ``token_id`` to rows with a ``word``; words outside the dictionary give no row.

    The most frequent words are the smallest ids. As many of them as fit in ``max_bytes`` are
    broadcast and joined without a shuffle, which takes every hot word out of the rest; what is
    left joins by shuffle, where the word of rank r holds at most one r-th of all tokens.
    """
    ids = dictionary.select("word", "token_id")
    limit = hot_limit(dictionary, max_bytes)
    if limit is None:
        return tokens.join(F.broadcast(ids), "word")
    hot = F.broadcast(ids.where(F.col("token_id") < limit))
    cold = ids.where(F.col("token_id") >= limit)
    known = tokens.join(hot, "word")
    others = tokens.join(hot.select("word"), "word", "left_anti").join(cold.hint("merge"), "word")
    return known.unionByName(others)


def sentence_token_ids(tokens: DataFrame, dictionary: DataFrame, max_bytes: int = HOT_BYTES, once: bool = False) -> DataFrame:
    """(keys, token_ids): the ids of each sentence in order; sentences without words give no row.

    Place and id travel as one BIGINT, eight bytes a token, and each task gathers the tokens it
    holds before the shuffle. A group is one sentence, which was one value in the input already.

    Given rows with a ``sentence`` in place of its tokens, hot words are looked up sentence by sentence, and only other words
    are joined. With ``once``, by which the caller says that no two rows share their keys, only sentences that hold such
    words are gathered again; without it, rows that share their keys become one sentence, as tokens do.
    """
    if "sentence" in tokens.columns:
        return _of_sentences(tokens, dictionary, max_bytes, once)
    keys = [c for c in tokens.columns if c not in ("tok_idx", "word")]
    packed = look_up(tokens, dictionary, max_bytes).select(*keys, _packed(F.col("tok_idx"), F.col("token_id")).alias("packed"))
    return _gathered(packed, keys, F.collect_list("packed"))


def _packed(place: Column, token_id: Column) -> Column:
    return F.shiftleft(place.cast("long"), ID_BITS).bitwiseOR(token_id.cast("long"))


def _gathered(packed: DataFrame, keys: list[str], listed: Column) -> DataFrame:
    gathered = packed.groupBy(*keys).agg(F.sort_array(listed).alias("packed"))
    ids = F.transform("packed", lambda x: x.bitwiseAND(F.lit(ID_MASK)).cast("int"))
    return gathered.select(*keys, ids.alias("token_ids"))


def _of_sentences(sentences: DataFrame, dictionary: DataFrame, max_bytes: int, once: bool) -> DataFrame:
    keys = [c for c in sentences.columns if c != "sentence"]
    limit = hot_limit(dictionary, max_bytes)
    hot = dictionary if limit is None else dictionary.where(F.col("token_id") < limit)
    # bounded: at most max_bytes, counted in the line before
    table = hot.select(F.col("word").cast("binary"), "token_id").toArrow()
    ids = dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in sentences.schema.fields if f.name in keys)
    encode = _encoder(sentences.sparkSession.sparkContext.broadcast(ids), len(keys), limit is not None)
    worded = sentences.where(F.rtrim("sentence") != "").select(*keys, F.col("sentence").cast("binary"))
    coded = worded.mapInArrow(encode, f"{types}_ids array<int>, _others array<struct<place: int, word: binary>>")
    known = F.filter("_ids", lambda x: x > 0)
    if limit is None and once:
        return coded.select(*keys, known.alias("token_ids")).where(F.size("token_ids") > 0)
    coded = stage_table(coded, "coded")
    whole = F.lit(once) & (F.size("_others") == 0)
    packed = F.filter(F.transform("_ids", lambda x, i: F.when(x > 0, _packed(i, x))), lambda x: x.isNotNull())
    open_ = coded.where(~whole).select(*keys, packed.alias("packed")).where(F.size("packed") > 0)
    if limit is not None:
        others = coded.select(*keys, F.explode("_others").alias("o")).select(*keys, F.col("o.place").alias("_place"), F.col("o.word").cast("string").alias("word"))
        cold = dictionary.where(F.col("token_id") >= limit).select("word", "token_id").hint("merge")
        open_ = open_.unionByName(others.join(cold, "word").select(*keys, F.array(_packed(F.col("_place"), F.col("token_id"))).alias("packed")))
    gathered = _gathered(open_, keys, F.flatten(F.collect_list("packed")))
    if not once:
        return gathered
    return coded.where(whole).select(*keys, known.alias("token_ids")).where(F.size("token_ids") > 0).unionByName(gathered)


def _encoder(table, n_keys: int, others: bool):
    """A task that gives each sentence's ids by place, 0 for a word that the table does not hold, and if asked these words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        look = {**table.value, b"": 0}.get
        for batch in batches:
            lists = pc.split_pattern(batch.column(n_keys), " ")
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int32)
            words = lists.flatten()
            # Each distinct word of the batch is looked up once.
            distinct = words.dictionary_encode()
            found = np.fromiter((look(w, -1) for w in distinct.dictionary.to_pylist()), np.int32, len(distinct.dictionary))
            ids = found[distinct.indices.to_numpy(zero_copy_only=False)]
            missing = np.flatnonzero(ids < 0) if others else np.zeros(0, np.int64)
            of = np.searchsorted(ends, missing, "right") - 1
            places = pa.array((missing - ends[of]).astype(np.int32))
            rest = pa.StructArray.from_arrays([places, words.take(pa.array(missing))], ["place", "word"])
            bounds = pa.array(np.searchsorted(missing, ends).astype(np.int32))
            made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.maximum(ids, 0))), pa.ListArray.from_arrays(bounds, rest)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keys], *made], [*batch.schema.names[:n_keys], "_ids", "_others"])

    return encode


def decode(ids: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(token_id, token) for distinct ids; equi-join, sized by Spark's own statistics."""
    names = dictionary.select("token_id", F.col("word").alias("token"))
    return ids.select("token_id").distinct().join(names, "token_id")
