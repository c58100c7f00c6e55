"""Line scans of tables and files."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.session import spread, stage_table

#: Bytes of file names and offsets that are broadcast; above, splits join by shuffle.
MAX_SPLIT_BYTES = 64 << 20
#: Endings of files that Spark decompresses: their size says nothing about their content.
PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Columns of a Parquet table, spread over the cores by the first one if it is small."""
    return spread(spark.read.parquet(path).select(*columns), columns[0])


def text_files(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(line) of all files under ``path`` whose names start with ``prefix``."""
    reader = spark.read.option("pathGlobFilter", f"{prefix}*") if prefix else spark.read
    return reader.text(path).withColumnRenamed("value", "line")


def text_files_with_offset(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(file, offset, line): each line with the byte offset of its start in its file.

    A split adds up the bytes of its own lines while it streams them; the bytes of the splits
    before it come from a small table with one row per split. Lines end at ``\\n``, ``\\r\\n`` or
    ``\\r``; a file without any ``\\n`` is one split. The three bytes of a byte-order mark, which the
    reader removes, show as missing from the file's size. Offsets of compressed files are those of their content; whether
    it opens with a mark is read from its first three bytes.
    """
    reader = spark.read.option("pathGlobFilter", f"{prefix}*") if prefix else spark.read
    scan = reader.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    lines = scan.select(
        meta.getField("file_path").alias("file"),
        meta.getField("file_block_start").alias("block"),
        meta.getField("file_size").alias("file_size"),
        F.col("value").alias("line"),
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
    )
    totals = lines.groupBy("file", "block", "file_size").agg(F.sum("bytes").alias("total"))
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.max("file_size").over(whole) - F.sum("total").over(whole)
    before = totals.select(
        "file",
        "block",
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"),
        F.when(~F.lower("file").rlike(PACKED) & (missing >= 2), 3).otherwise(0).alias("mark"),
    )
    running = lines.drop("file_size", "bytes").mapInArrow(
        _running_place(), "file string, block long, line string, place long"
    )
    offset = F.col("before") + F.col("place")
    splits = stage_table(before, "splits")
    packed = splits.where(F.lower("file").rlike(PACKED)).select("file").distinct().collect()
    if marked := _marked(spark, [r.file for r in packed]):
        of_packed = spark.createDataFrame(pa.table({"file": marked, "_mark": [3] * len(marked)}))
        splits = splits.join(of_packed, "file", "left").withColumn("mark", F.coalesce(F.col("_mark").cast("int"), "mark")).drop("_mark")
    if (splits.agg(F.sum(F.octet_length("file") + 32)).first()[0] or 0) <= MAX_SPLIT_BYTES:
        splits = F.broadcast(splits)
    return running.join(splits, ["file", "block"]).select(
        "file",
        F.when(offset > 0, offset + F.col("mark")).otherwise(offset).alias("offset"),
        "line",
    )


def _marked(spark: SparkSession, names: list[str]) -> list[str]:
    """The compressed files whose content opens with a byte-order mark; three bytes of each are read, many files at a time."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(configuration)

    def opens_with_mark(name: str) -> bool:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        files = at.getFileSystem(configuration)
        stream = codecs.getCodec(at).createInputStream(files.open(at))
        try:
            return [stream.read() for _ in range(3)] == list(b"\xef\xbb\xbf")
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return [name for name, found in zip(names, pool.map(opens_with_mark, names)) if found]


def _running_place():
    """A streaming task: cuts rows at ``\\r`` and gives the bytes before each line in its own split."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        last, carried = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            pieces = pc.split_pattern(batch.column("line"), "\r")
            of_row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(pieces).to_numpy())
            line = pieces.flatten()
            size = pc.binary_length(line).to_numpy() + 1
            # An empty piece after the last mark of a row is the rest of a two-byte terminator.
            closes = np.append(of_row[1:] != of_row[:-1], True)
            opens = np.insert(closes[:-1], 0, True)
            rest = closes & ~opens & (size == 1)
            size[:-1] += rest[1:]
            kept = ~rest
            line, of_row, size = line.filter(pa.array(kept)), of_row[kept], size[kept].astype(np.int64)

            file, block = batch.column("file").take(pa.array(of_row)), batch.column("block").to_numpy()[of_row]
            rows = len(of_row)
            fresh = np.ones(rows, dtype=bool)
            fresh[0] = (file[0].as_py(), block[0]) != last
            other_file = pc.not_equal(file.slice(1), file.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            fresh[1:] = other_file | (block[1:] != block[:-1])
            begin = np.cumsum(size) - size
            opened = np.maximum.accumulate(np.where(fresh, np.arange(rows), -1))
            place = begin - np.where(opened >= 0, begin[opened], -carried)
            last, carried = (file[rows - 1].as_py(), block[-1]), int(place[-1] + size[-1])
            yield pa.record_batch(
                [file, pa.array(block, pa.int64()), line, pa.array(place, pa.int64())],
                names=["file", "block", "line", "place"],
            )

    return task
