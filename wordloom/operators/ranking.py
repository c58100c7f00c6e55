"""Dense positions over a whole table, without one task seeing the whole table."""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.session import stage_table

# Fixed value: how Spark names the files of each range.
PART_NUMBER = re.compile(r"part-(\d+)")


def with_position(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Add the position of each row in ``order``, which must be total.

    The rows are range-sorted and written to the checkpoint folder range by range. A row's
    position is its place in its file plus the rows of the files before it, so it is the same
    however the files are read later. Only one count per file reaches the driver, and no window
    over the whole table is needed.
    """
    ordered = stage_table(df.orderBy(*order), "ordered")
    meta = F.col("_metadata")
    placed = ordered.select(
        *ordered.columns, meta.getField("file_name").alias("_file"), meta.getField("row_index").alias("_place")
    )
    sizes = placed.groupBy("_file").count().collect()
    sizes.sort(key=lambda r: (int(PART_NUMBER.match(r["_file"]).group(1)), r["_file"]))
    before = list(accumulate((r["count"] for r in sizes), initial=start))[: len(sizes)]
    offsets = pa.table(
        {"_file": pa.array([r["_file"] for r in sizes], pa.string()), "_before": pa.array(before, pa.int64())}
    )
    return placed.join(F.broadcast(df.sparkSession.createDataFrame(offsets)), "_file").select(
        *ordered.columns, (F.col("_before") + F.col("_place")).alias(name)
    )
