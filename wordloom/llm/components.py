"""Connected components of a table of links, by stars that shrink to their smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.session import stage_table


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b); the component is its smallest id.

    Each round joins every link to the smallest neighbour of its ends, so no neighbour list is
    ever gathered, and stages the links in the shared folder. Rounds grow with the logarithm of the
    number of ids. Links of an id with itself and repeated links change nothing; no links give no
    rows.
    """
    edges = stage_table(_tidy(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = stage_table(_tidy(_small_star(_large_star(edges))), "links")
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _tidy(edges: DataFrame) -> DataFrame:
    """Larger end first, each link once."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _tidy(edges)
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
