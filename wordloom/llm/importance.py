"""Target-distribution importance resampling over hashed n-grams, by prefix CRCs.

Features are the runs of one to ``WIDEST`` neighbouring words, joined by one space; a feature's bucket
is the crc32 of its bytes modulo ``BUCKETS``. A text is brought into its normal form, words with single
spaces, and scanned once: the running CRC register at every word's start and end is kept. The
CRC of any run then follows from two of them without reading its bytes again: the register is linear
over GF(2), so the part that stems from the bytes before the run is the start's register shifted
by the run's length, and an exclusive or cancels it. A shift by up to 255 bytes is four table
look-ups, a longer one a product of shifts by powers of two.

A bucket's gain is the logarithm of its smoothed share in the target over its share in all documents. A
document weighs the sum of its features' gains; a Gumbel number from a seeded hash of its id turns the
weights into a draw without replacement by taking the highest scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.alnum import Words, normal_form
from wordloom.llm.words import slices
from wordloom.operators.ranking import with_position
from wordloom.session import stage_table

BUCKETS = 10_000
WIDEST = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
#: Words whose registers are held at a time.
BLOCK = 1 << 16
#: Bytes of one lane; lanes of a block are scanned side by side.
LANE = 255

# Fixed value: the reflected polynomial of crc32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), np.uint32(POLYNOMIAL) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_STEP = _byte_table()


def _step(register: np.ndarray, byte: np.ndarray | int = 0) -> np.ndarray:
    return _STEP[(register ^ byte) & np.uint32(255)] ^ (register >> np.uint32(8))


def _look_up(tables: np.ndarray, base: np.ndarray | int, register: np.ndarray) -> np.ndarray:
    """The shift that ``tables`` holds from ``base`` on: one part for each byte of the register."""
    r = register.astype(np.int64)
    return (
        tables[base + (r & 255)] ^ tables[base + 256 + (r >> 8 & 255)] ^ tables[base + 512 + (r >> 16 & 255)] ^ tables[base + 768 + (r >> 24)]
    )


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables of the shifts by 0 to 255 bytes, and of those by 256, 512, ... bytes."""
    parts = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    short = np.empty((256, 1024), np.uint32)
    for n in range(256):
        short[n] = parts
        parts = _step(parts)
    long = [parts]
    for _ in range(23):
        long.append(_look_up(long[-1], 0, long[-1]))
    return short.reshape(-1), long


_SHORT, _LONG = _shift_tables()


def shift(register: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What is left of each register after so many zero bytes."""
    out = _look_up(_SHORT, (n_bytes & 255) * 1024, register)
    high = n_bytes >> 8
    for table in _LONG:
        if not high.any():
            break
        at = np.flatnonzero(high & 1)
        out[at] = _look_up(table, 0, out[at])
        high = high >> 1
    return out


def registers(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The CRC register, from zero, after the first ``places[i]`` bytes of ``data``; one scan of the bytes."""
    lanes = len(data) // LANE + 1
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[: len(data)] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    running = np.zeros((LANE + 1, lanes), np.uint32)
    for k in range(LANE):
        running[k + 1] = _step(running[k], columns[k])
    carry = [0]
    tables = memoryview(_SHORT[LANE * 1024 :])
    for end in running[LANE, :-1].tolist():
        c = carry[-1]
        carry.append(tables[c & 255] ^ tables[256 + (c >> 8 & 255)] ^ tables[512 + (c >> 16 & 255)] ^ tables[768 + (c >> 24)] ^ end)
    lane, k = np.divmod(places, LANE)
    return shift(np.array(carry, np.uint32)[lane], k) ^ running[k, lane]


def feature_crcs(words: Words, widest: int = WIDEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, crc32) of every run of 1 to ``widest`` words that lies in one row, block by block."""
    last = np.cumsum(words.per_row)
    for a in range(0, len(words.starts), BLOCK):
        b = min(a + BLOCK, len(words.starts))
        stop = min(b + widest - 1, len(words.starts))
        base = words.starts[a]
        begin, end = words.starts[a:stop] - base, words.ends[a:stop] - base
        found = registers(words.data[base : base + end[-1]], np.concatenate([begin[: b - a], end]))
        before, after = found[: b - a] ^ ONES, found[b - a :]
        row = np.searchsorted(last, np.arange(a, b), "right")
        room = last[row] - np.arange(a, b)
        for width in range(1, widest + 1):
            first = np.flatnonzero(room >= width)
            final = first + width - 1
            yield row[first], after[final] ^ shift(before[first], end[final] - begin[first]) ^ ONES


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, widest: int = WIDEST) -> DataFrame:
    """(bucket, n) of all texts: each task adds up its own buckets first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch):
                for _, crc in feature_crcs(normal_form(piece.column(0)), widest):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    column = texts.select(F.col(text).cast("string").alias("text"))
    return column.mapInArrow(task, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket in thousandths, from two tables of ``bucket_counts``; ``buckets`` numbers on the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, table in ((s, documents), (t, target)):
        for bucket, n in table.collect():
            counts[bucket] = n
    in_all, in_target = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((int(b) + 1) * in_all / ((int(a) + 1) * in_target))) for a, b in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, widest: int = WIDEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of ``docs`` (doc_id, text); map-only."""
    key = docs.schema["doc_id"].dataType.simpleString()
    buckets = len(gain)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words = normal_form(piece.column(1))
                weight = np.zeros(piece.num_rows, np.int64)
                for row, crc in feature_crcs(words, widest):
                    if len(row):  # rows are in order: sums of whole runs of one row
                        first = np.flatnonzero(np.diff(row, prepend=-1))
                        weight[row[first]] += np.add.reduceat(gain[crc % np.uint32(buckets)], first)
                n = words.per_row
                features = sum(np.maximum(n - width + 1, 0) for width in range(1, widest + 1))
                yield pa.record_batch(
                    [piece.column(0), *(pa.array(x, pa.int64()) for x in (n, features, weight))], names=["doc_id", "n_words", "n_features", "weight"]
                )

    column = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return column.mapInArrow(task, f"doc_id {key}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs`` (doc_id, text, any other columns).

    ``target`` (text, any other columns) holds the texts to resemble. Of the N rows with at least
    ``least_words`` words the floor(percent * N / 100) highest scores are drawn, ties to the smaller
    doc_id; ``rank`` counts them from 1 and is null for all other rows. A null text is empty: weight 0, no
    rank. Repeated rows are drawn one by one; a null doc_id has the hash of an empty id and comes first among
    ties. An empty target or table gives every bucket its smoothed share; an empty table gives no rows.
    Nothing but one number per bucket reaches the driver; ranks come from a range sort of ids and scores.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = weigh(docs, gain)
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = stage_table(rows.withColumn("score", F.col("weight") + noise), "weighed")
    fit = F.col("n_words") >= least_words
    drawn = percent * rows.where(fit).count() // 100
    ranked = with_position(rows.where(fit), [F.desc("score"), F.asc("doc_id")], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).unionByName(rows.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))
