"""Sinks: Parquet, quoted CSV, tab-separated text, ordered or single-file output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wordloom.session import file_system


def as_text(df: DataFrame, separator: str = ";") -> DataFrame:
    """Arrays joined to text, for the text formats."""
    flat = [
        F.array_join(F.col(f.name).cast("array<string>"), separator).alias(f.name)
        if isinstance(f.dataType, ArrayType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*flat)


SEPARATORS = {"csv": ",", "tsv": "\t"}


def write_files(df: DataFrame, path: str, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Write as ``parquet``, ``csv`` or ``tsv`` into a folder that is not there yet."""
    if form == "parquet":
        df.write.partitionBy(*partition_by).parquet(path)
    elif form in SEPARATORS:
        # the writer quotes fields that open with its comment character, a number sign unless set
        as_text(df).write.partitionBy(*partition_by).option("comment", "\u0001").csv(
            path, sep=SEPARATORS[form], quote='"', escape='"', emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    else:
        raise ValueError(f"unknown format {form!r}")


def write_table(df: DataFrame, path: str, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Write as ``parquet``, ``csv`` or ``tsv``; what is there is replaced once the new table is complete.

    The table is written to a sibling folder first. A job that fails leaves the old one as it was, and a rename that
    fails moves it back. Where renames are no single step, use ``versions``.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    new, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    files, target = file_system(spark, path)
    _, fresh = file_system(spark, new)
    try:
        write_files(df, new, form, partition_by)
    except Exception:
        files.delete(fresh, True)
        raise
    _, aside = file_system(spark, old)
    replaced = files.exists(target)
    if replaced and not _moved(files, target, aside):
        raise OSError(f"{path} can't be moved aside; the new table is {new}")
    if not _moved(files, fresh, target):
        if replaced and not _moved(files, aside, target):
            raise OSError(f"neither {new} nor the old table can be moved to {path}; the old one is {old}")
        raise OSError(f"{new} can't be moved to {path}, which is as it was")
    if replaced:
        files.delete(aside, True)


def _moved(files, source, target) -> bool:
    """Whether a rename went through; a file system may say no or raise."""
    try:
        return files.rename(source, target)
    except Exception:  # noqa: BLE001
        return False


def publish(
    df: DataFrame,
    path: str,
    order: list[str],
    form: str = "parquet",
    columns: list[str | Column] | None = None,
    single_file: bool = False,
) -> None:
    """Write ``columns`` (all by default) in order: file names sort as the rows do.

    The rows stay in range-sorted parts, so that no task has to see all of them; ``single_file`` sorts
    them in one task into one file, for results that the caller knows to be small.
    """
    ordered = df.coalesce(1).sortWithinPartitions(*order) if single_file else df.orderBy(*order)
    write_table(ordered.select(*(columns or df.columns)), path, form)
