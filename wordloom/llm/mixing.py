"""Mixing sources to target weights by subset sums over exact text lengths.

A source's target is its share of all words, at most ``MOST`` times its own words. Whole repeats of
the source fill most of it; the rest, less than the source has, is a bounded knapsack: texts are counted by exact length, and
dynamic programming picks how many of each length to take once more so that the sum comes as near to
the rest as it can. Where that misses the target, one knapsack over ``MOST`` copies of every text takes its
place if it comes nearer. Which texts of a length are taken follows from a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.words import GAP
from wordloom.session import stage_table

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 42
#: Hash parts of the texts of one source and length; each is ranked alone.
PARTS = 256
#: Most words that dynamic programming fills; the rest before it is dealt in proportion.
WINDOW = 1 << 16

KEY = "source_key"
NO_SOURCE = "\U0010ffff"


def text_size(text: str) -> Column:
    """Words of a text; 0 for null."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), GAP, -1), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source_key, source_size, target) per source from (source_key, source_size).

    The cap of a source binds when the common rate reaches cap / weight. Sources in the order of that
    rate are capped as long as the rate left for the others is above it.
    """
    order = Window.orderBy(F.col(KEY).asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))).withColumn("cap", (MOST * F.col("source_size")).cast("double"))
    by_rate = Window.orderBy(F.col("cap") / F.col("weight"), KEY)
    before, after = by_rate.rowsBetween(Window.unboundedPreceding, -1), by_rate.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("total", F.sum("source_size").over(everything)).withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rate = (F.col("total") - F.col("spent")) / F.sum("weight").over(after)
    rows = rows.withColumn("rate", F.when(rate * F.col("weight") < F.col("cap"), rate))
    common = F.first("rate", ignorenulls=True).over(by_rate.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    free = F.coalesce(common, F.lit(float("inf")))
    return rows.select(KEY, "source_size", F.least("cap", F.col("weight") * free).alias("target"))


def fill(lengths: np.ndarray, counts: np.ndarray, rest: int, seed: int = SEED) -> np.ndarray:
    """How many texts of each length to take so that their words come as near to ``rest`` as they can, not above.

    Beyond ``WINDOW`` words a share of each length is taken first, then one more of each in a seeded
    order; the last words are an exact bounded knapsack.
    """
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    rest = min(rest, total)
    if rest == total:
        return counts.copy()
    if rest > WINDOW and 2 * rest > total:  # what stays out is the smaller side
        out = fill(lengths, counts, total - rest, seed)
        if (lengths * out).sum() == total - rest:
            return counts - out
    aim = max(0, rest - WINDOW)
    taken = counts * aim // max(1, total) if total < (1 << 62) // max(1, int(counts.max(initial=0))) else (counts * (aim / total)).astype(np.int64)
    left = rest - int((lengths * taken).sum())
    order = np.random.default_rng(seed).permutation(len(lengths))
    while left > WINDOW:  # each pass takes a text of every length that still has one and fits
        room = left
        for k in order:
            if taken[k] < counts[k] and lengths[k] <= left - WINDOW // 2:
                more = 1 if left - lengths[k] > WINDOW // 2 else 0
                taken[k] += more
                left -= more * int(lengths[k])
        if left == room:
            break
    return taken + _knapsack(lengths, counts - taken, left, order)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, rest: int, order: np.ndarray) -> np.ndarray:
    """Exact bounded subset sum nearest below ``rest``: by[s] is the item that first reached the sum s."""
    by, amount = np.full(rest + 1, -1, np.int32), np.zeros(rest + 1, np.int64)
    by[0] = len(lengths)
    for k in order:
        n, one = min(int(counts[k]), rest // max(1, int(lengths[k]))), int(lengths[k])
        bunch = 1
        while n > 0 and one > 0 and by[rest] < 0:
            m = min(bunch, n)
            step = m * one
            new = np.flatnonzero((by[: rest + 1 - step] >= 0) & (by[step:] < 0)) + step
            by[new], amount[new] = k, m
            n, bunch = n - m, 2 * bunch
        if by[rest] >= 0:
            break
    out, at = np.zeros(len(lengths), np.int64), int(np.flatnonzero(by >= 0)[-1])
    while at:
        k, m = by[at], amount[at]
        out[k] += m
        at -= int(m) * int(lengths[k])
    return out


def _choose(frame: pd.DataFrame) -> pd.DataFrame:
    """How often all texts of each length of one source are taken, and how many of them once more than that."""
    frame = frame.sort_values("size", ignore_index=True)
    target, size = frame["target"].iloc[0], int(frame["source_size"].iloc[0])
    whole = int(min(MOST, target // size)) if size else 0
    lengths, counts = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
    rest = int(round(target - whole * size)) if whole < MOST else 0
    extra = fill(lengths, counts, rest)
    if rest > int((lengths * extra).sum()):  # few or long texts: any number of copies of each may come nearer
        free = fill(lengths, counts * MOST, whole * size + rest)
        if (lengths * free).sum() > whole * size + (lengths * extra).sum():
            whole, extra = 0, free
    extra = np.where(lengths > 0, extra, 0)
    return frame.assign(whole=whole + extra // counts, extra=extra % counts)[[KEY, "size", "whole", "extra"]]


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats, taken) per row of ``docs`` (doc_id, text, source, any other columns).

    ``repeats`` is how often the mix holds the text, 0 to 3, and ``taken`` its words times that. A null
    or empty text has size 0 and is taken as often as its source is whole; a null source is a source of
    its own, the last. A source without words has target 0. Texts are told apart by doc_id and text, and
    rows that agree in both by their order among equals, which changes no row's values as a whole.
    An empty table gives no rows. Reruns agree, whatever the partitions.
    """
    key = F.when(F.col("source").isNotNull(), F.concat(F.lit("="), F.col("source").cast("string")))
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", key.alias(KEY), text_size("text").alias("size"), mark.alias("mark"))
    rows = stage_table(rows.withColumn(KEY, F.coalesce(KEY, F.lit(NO_SOURCE))).withColumn("part", F.pmod("mark", F.lit(PARTS))), "mix")
    parts = rows.groupBy(KEY, "size", "part").agg(F.count("*").alias("n"))
    lengths = parts.groupBy(KEY, "size").agg(F.sum("n").alias("n"))
    sources = targets(lengths.groupBy(KEY).agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights)
    plan = lengths.join(sources, KEY).groupBy(KEY).applyInPandas(_choose, f"{KEY} string, size bigint, whole bigint, extra bigint")
    before = F.coalesce(F.sum("n").over(Window.partitionBy(KEY, "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = parts.join(plan, [KEY, "size"]).withColumn("quota", F.greatest(F.lit(0), F.least("n", F.col("extra") - before)))
    shares = shares.join(sources, KEY).select(KEY, "size", "part", "whole", "quota", "source_size", "target")
    rank = F.row_number().over(Window.partitionBy(KEY, "size", "part").orderBy("mark", "doc_id"))
    chosen = rows.join(shares, [KEY, "size", "part"]).withColumn("repeats", F.col("whole") + (rank <= F.col("quota")).cast("long"))
    source = F.when(F.col(KEY) != NO_SOURCE, F.substring(KEY, 2, 1 << 30)).alias("source")
    return chosen.select("doc_id", source, "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))
