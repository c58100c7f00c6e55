"""Benchmark decontamination: short test items found inside long documents, without Python.

Containment search by MinHash, partitioned by size. An item of q shingles is in a document when at
least ``need`` = ceil(t q) of them are. Any q - need + 1 of its shingles then include one of the
document's, so the item's sketch is its q - need + 1 smallest hashes: the sketch length follows from
the item's size, and no contained item is missed however long the document. Items and documents are
parted by powers of two of their size, and a document only meets items that fit into its part.
Candidates are then verified by counting the shingles they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import GAP
from wordloom.session import stage_table

WIDTH = 5
PERCENT = 80
#: Most rows of a side that is broadcast (under 100 MB); a larger side is joined by a shuffle.
BROADCAST_ROWS = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint where its counted rows allow one."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def words(text: str) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), GAP, -1), lambda w: w != "")


def windows(width: int) -> Column:
    """Distinct hashes of the runs of ``width`` neighbours in the column ``words``."""
    run = ", ".join(f"get(words, i + {j})" for j in range(width))
    return F.expr(f"CASE WHEN size(words) >= {width} THEN array_distinct(transform(sequence(0, size(words) - {width}), i -> xxhash64({run}))) ELSE array() END")


def items_of(benchmark: DataFrame, width: int, percent: int) -> DataFrame:
    """(item_id, width, shingles, n_item, need, sketch) of the items with a word.

    An item of fewer words than ``width`` is one shingle of all its words.
    """
    rows = benchmark.select("item_id", words("text").alias("words")).where("size(words) > 0")
    rows = rows.withColumn("width", F.least(F.size("words"), F.lit(width)))
    case = F.when(F.col("width") == 1, windows(1))
    for k in range(2, width + 1):
        case = case.when(F.col("width") == k, windows(k))
    rows = rows.withColumn("shingles", F.array_sort(case)).withColumn("n_item", F.size("shingles").cast("long"))
    rows = rows.withColumn("need", F.expr(f"({percent} * n_item + 99) div 100"))
    return rows.select("item_id", "width", "shingles", "n_item", "need", F.slice("shingles", F.lit(1), (F.col("n_item") - F.col("need") + 1).cast("int")).alias("sketch"))


def _doc_shingles(docs: DataFrame, widths: list[int]) -> DataFrame:
    """(doc_id, width, part, shingle), each distinct shingle of a row once; ``part`` grows with the row's size."""
    rows = docs.select("doc_id", words("text").alias("words"))
    rows = rows.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("width"), windows(k).alias("s")) for k in widths])).alias("e"))
    part = F.ceil(F.log2(F.size("e.s"))).cast("int")
    return rows.where("size(e.s) > 0").select("doc_id", "e.width", part.alias("part"), F.explode("e.s").alias("shingle"))


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every benchmark item a document holds.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text, both any other columns. Rows of one
    doc_id are taken as one text that repeats and change nothing; a null doc_id or item_id is left out.
    Null or empty texts, or texts without words, hold nothing and are held by nothing. Equal items are
    all reported. Empty tables give no rows.
    """
    items = stage_table(items_of(benchmark.where("item_id is not null").select("item_id", "text").distinct(), width, percent), "items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # width values at most
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    if not widths:
        widths = [width]
    least_part = F.ceil(F.log2("need")).cast("int")
    sketches = items.select("width", F.explode("sketch").alias("shingle"), least_part.alias("least_part")).groupBy("width", "shingle").agg(F.min("least_part").alias("least_part"))
    met = _doc_shingles(docs, widths).alias("d").join(small(sketches).alias("s"), ["width", "shingle"]).where("d.part >= s.least_part")
    hits = met.select("doc_id", "width", "shingle").distinct()
    by_sketch = items.select("item_id", "width", F.explode("sketch").alias("shingle"))
    candidates = stage_table(hits.join(small(by_sketch), ["width", "shingle"]).select("doc_id", "item_id", "width").distinct(), "candidates")
    of_items = items.select("item_id", "width", "need", "n_item", F.explode("shingles").alias("shingle"))
    chosen = docs.join(small(candidates.select("doc_id").distinct()), "doc_id", "left_semi")
    shared = _doc_shingles(chosen, widths).join(small(of_items), ["width", "shingle"]).select("doc_id", "item_id", "need", "n_item", "shingle")
    counted = shared.distinct().groupBy("doc_id", "item_id", "need", "n_item").agg(F.count("*").alias("n_shared")).where("n_shared >= need")
    found = counted.join(small(candidates.select("doc_id", "item_id")), ["doc_id", "item_id"], "left_semi")
    return found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
