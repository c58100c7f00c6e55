"""Even shards of whole records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.operators.ranking import with_position
from wordloom.session import stage_table

#: Records whose running sums one task makes.
BLOCK = 1 << 16


def shard_by_id(key: str, n: int) -> Column:
    """Shard of a numeric id."""
    return F.pmod(F.col(key), F.lit(n)).cast("int")


def shard_by_hash(keys: list[str], n: int) -> Column:
    """Shard by a hash of any keys: even whatever their pattern, and the same on every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def shard_by_bytes(rows: DataFrame, order: list[str], size: Column, n: int) -> DataFrame:
    """Add ``shard_id``: ``n`` runs of whole records in ``order``, which must be total, of equal bytes up to one record.

    ``size`` is a record's bytes; null counts as none. A record is in the shard in which its first byte falls when all bytes are cut
    into ``n`` equal ranges. The sum of the bytes before it is made in three parts: records are range-sorted and cut into blocks
    of ``BLOCK``, each block sums its own, and only one row per block is summed over the whole.
    """
    columns = rows.columns
    placed = with_position(rows.withColumn("_bytes", F.coalesce(size, F.lit(0)).cast("long")), [F.asc_nulls_first(c) for c in order], "_at", 0)
    placed = placed.withColumn("_block", F.floor(F.col("_at") / BLOCK).cast("long"))
    totals = stage_table(placed.groupBy("_block").agg(F.sum("_bytes").alias("_in_block")), "block-bytes")
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_block", F.coalesce(F.sum("_in_block").over(earlier), F.lit(0)).alias("_before"))
    total = totals.agg(F.sum("_in_block")).first()[0] or 0
    running = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("_before") + F.sum("_bytes").over(running) - F.col("_bytes")
    shard = F.floor(start.cast("decimal(38,0)") * n / max(1, total)).cast("int")
    # only the last records can be empty ones behind the last byte
    return placed.join(before, "_block").withColumn("shard_id", F.least(shard, F.lit(n - 1))).select(*columns, "shard_id")


def shard_sizes(sharded: DataFrame, text: str) -> DataFrame:
    """(shard_id, n_rows, n_bytes)"""
    return sharded.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length(text)).cast("long").alias("n_bytes")
    )
