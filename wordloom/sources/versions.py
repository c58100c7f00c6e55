"""Tables published without a rename, for stores where moving a folder is no single step.

Each version is written into a folder of its own. Publishing it is the creation of one small commit file with
the next number, which names the folder; the table is what the complete commit of the highest number names.
Every step before leaves the old version current, and an older one is published again by one more commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wordloom.session import file_system
from wordloom.sources.writers import write_files

#: Ends a commit; a file without it was cut off and counts as none.
END = "\n"


def commits(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of each complete commit by its number."""
    files, at = file_system(spark, f"{path}/_commits")
    if not files.exists(at):
        return {}
    found = {}
    for status in files.listStatus(at):
        name = status.getPath().getName()
        if name.isdigit():
            stream = files.open(status.getPath())
            try:
                text = bytes(stream.readNBytes(4096)).decode()
            finally:
                stream.close()
            if text.endswith(END):
                found[int(name)] = f"{path}/{text[: -len(END)]}"
    return found


def current(spark: SparkSession, path: str) -> str:
    """The folder of the table's present version."""
    published = commits(spark, path)
    if not published:
        raise FileNotFoundError(f"{path} has no published version")
    return published[max(published)]


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The present version of a Parquet table, or that of a commit."""
    return spark.read.parquet(current(spark, path) if number is None else commits(spark, path)[number])


def _commit(spark: SparkSession, path: str, folder: str) -> int:
    """Name the folder in the first free number. A number that exists was taken by another writer, or cut off."""
    files, at = file_system(spark, f"{path}/_commits")
    files.mkdirs(at)
    taken = [int(s.getPath().getName()) for s in files.listStatus(at) if s.getPath().getName().isdigit()]
    number = max(taken, default=0) + 1
    while True:
        _, file = file_system(spark, f"{path}/_commits/{number:010d}")
        if not files.exists(file):
            stream = files.create(file, False)  # refuses a file that another writer has made since
            try:
                stream.write(bytearray((folder + END).encode()))
            finally:
                stream.close()
            return number
        number += 1


def write_version(df: DataFrame, path: str, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Write and publish a version; returns its folder. A failure at any step leaves the version before as it was."""
    spark, folder = df.sparkSession, f"version-{uuid.uuid4().hex}"
    files, fresh = file_system(spark, f"{path}/{folder}")
    try:
        write_files(df, f"{path}/{folder}", form, partition_by)
        _commit(spark, path, folder)
    except Exception:
        if f"{path}/{folder}" not in commits(spark, path).values():
            files.delete(fresh, True)
        raise
    return f"{path}/{folder}"


def roll_back(spark: SparkSession, path: str, number: int) -> int:
    """Publish the version of an earlier commit again; returns the number of the new commit."""
    return _commit(spark, path, commits(spark, path)[number].rsplit("/", 1)[1])


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the ``keep`` versions published last, their commits first; returns how many versions went."""
    published = commits(spark, path)
    kept: list[str] = []
    for number in sorted(published, reverse=True):
        if published[number] not in kept and len(kept) < keep:
            kept.append(published[number])
    files, _ = file_system(spark, path)
    for number, folder in published.items():
        if folder not in kept:
            files.delete(file_system(spark, f"{path}/_commits/{number:010d}")[1], False)
    gone = {folder for folder in published.values() if folder not in kept}
    for folder in gone:
        files.delete(file_system(spark, folder)[1], True)
    return len(gone)
