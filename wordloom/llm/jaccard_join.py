"""Similarity join on word shingles: a blocked sparse product of the document by n-gram matrix.

Rows of the matrix are distinct shingle sets (copies collapse into one row), columns are shingles.

1. *Column blocks.* The matrix is cut by shingle hash into blocks of about ``CELL`` entries. A block
   counts how many rows each column has. A column of one row adds nothing to any product and goes.
2. *Row blocks.* Each row gets its columns back, rarest first. Two rows of sizes n and m that agree
   have a common column among the first n - ceil(t n) + 1 places of the row: rows whose places
   there are all columns of their own are done. Places past that bound are never multiplied.
3. *Product.* Rows meet on those columns, which gives the places of the product to compute. The
   places are dealt to tiles (a row with many of them to several), each tile gets its rows once, and
   numpy multiplies tile by tile: column block after column block adds to the overlap counts, and a
   pair goes as soon as its count and the entries left must stay below t (n + m) / (1 + t).

For components alone, pairs inside one component need no product: each column first multiplies its
rows with one row of its own and one of their part (a star), and only rows that are still in different
components meet in full. That keeps a large group of near copies linear, and loses no link. ``jaccard_links`` gives
every link between different texts instead.

Columns held by a large share of all rows are found beforehand (at most ``HOT_SHARE`` times the mean
set size, whatever the corpus), take the last places and are dealt by row instead of by column. Rows
of one column are parted by their ids wherever they are grouped, into about as many parts as a part
has rows at most, so no column is one task.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.components import components
from wordloom.llm.decontam import small
from wordloom.llm.words import shingle_sets, slices
from wordloom.session import stage_table

WIDTH = 4
PERCENT = 85
#: Entries of a column block, on average.
CELL = 1 << 21
#: A column of more than one in so many documents counts as hot.
HOT_SHARE = 64
#: Blocks among which the entries of hot columns are dealt, by row.
HOT_BLOCKS = 1 << 12
LAST = (1 << 32) - 1
#: Texts, or else entries, among which a task looks for hot columns at a time.
LOOK_ROWS, LOOK_ENTRIES = 512, 1 << 20
#: Pairs of one row that share a tile; a row with more is sent to several.
SPLIT = 256
#: Column blocks of a tile, and entries multiplied at a time.
SLABS = 8
STEP = 1 << 20


def signature(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _often(sets: list[np.ndarray]) -> list[dict]:
    """The columns that many of these sets hold, with their number."""
    if not sets:
        return []
    columns, n = np.unique(np.concatenate(sets), return_counts=True)
    often = n >= max(4, len(sets) / (2 * HOT_SHARE))
    return [{"shingle": c, "n": k} for c, k in zip(columns[often].view(np.int64).tolist(), n[often].tolist(), strict=True)]


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Signature and size of each set; the first row of a piece may also name hot columns of the texts so far."""
    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())]))
    seen: list = []
    held_back = None

    def described(ids: pa.Array, sigs: list, sizes: list, hot: list | None) -> pa.RecordBatch:
        columns = [ids, pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64()), pa.array([hot, *[None] * (len(sigs) - 1)], kind)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "sig", "n_shingles", "hot"])

    for batch in chain.from_iterable(map(slices, batches)):
        if not batch.num_rows:
            continue
        if held_back:
            enough = len(seen) >= LOOK_ROWS or sum(map(len, seen)) >= LOOK_ENTRIES
            yield described(*held_back, _often(seen) if enough else None)
            seen = [] if enough else seen
        sets = list(shingle_sets(batch.column(1), width))
        seen += sets
        held_back = batch.column(0), [signature(s) if len(s) else None for s in sets], [len(s) for s in sets]
    if held_back:
        yield described(*held_back, _often(seen))


def describe(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, sig, n_shingles, hot) per document; ``sig`` is null for a document without words."""
    schema = "doc_id bigint, sig binary, n_shingles bigint, hot array<struct<shingle: bigint, n: bigint>>"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(partial(_describe, width=width), schema)


CELLS = "block int, sigs binary, sizes binary, counts binary, shingles binary, held binary"


def pack(numbers: np.ndarray) -> bytes:
    """The low 56 bits of each."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view(np.uint64).reshape(-1)


def block_of(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are ranges of hashes."""
    return ((shingles >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def column_names(low: np.ndarray, block: int, blocks: int) -> np.ndarray:
    """The hashes of a block from their low 56 bits.

    A range of 2 ** 56 holds each low part once, so from 256 blocks on nothing is lost. Of fewer blocks (32 at least) a name tells
    61 bits of the hash, which is as good as all of them on tables that small.
    """
    base = np.uint64(-(-(block << 32) // blocks) << 32)
    return base + ((low - base) & np.uint64((1 << 56) - 1))


def _cell(block: int, sigs: np.ndarray, sizes: np.ndarray, owner: np.ndarray, shingles: np.ndarray, held: np.ndarray | None = None) -> dict:
    """One row of CELLS: entries sorted by owner, owners written once with their number of entries.

    Cells of column blocks hold packed shingles (hot ones: places in the list), those of row blocks whole ones and ``held``.
    """
    who, n = np.unique(owner, return_counts=True)
    return {
        "block": block,
        "sigs": sigs[who].tobytes(),
        "sizes": sizes[who].astype(np.uint32).tobytes(),
        "counts": n.astype(np.uint32).tobytes(),
        "shingles": shingles.tobytes() if held is not None else pack(shingles),
        "held": b"" if held is None else held.astype(np.uint32).tobytes(),
    }


def _entries(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Distinct signatures and their sizes, and of each entry the owner, the shingle and ``held``."""
    join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    sigs, at, back = np.unique(join("sigs", "V16"), return_index=True, return_inverse=True)
    owner = np.repeat(back.astype(np.int32), join("counts", np.uint32))
    held = join("held", np.uint32)
    shingles = join("shingles", np.uint64) if len(held) else unpack(b"".join(table.column("shingles").to_pylist()))
    return sigs, join("sizes", np.uint32)[at], owner, shingles, held


def _to_cells(batches: Iterator[pa.RecordBatch], width: int, blocks: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(map(slices, batches)):
        sets = {signature(s): s for s in shingle_sets(batch.column(0), width) if len(s)}
        if not sets:
            continue
        sigs = np.frombuffer(b"".join(sets), "V16")
        sizes = np.array([len(s) for s in sets.values()])
        owner, shingles = np.repeat(np.arange(len(sets)), sizes), np.concatenate(list(sets.values()))
        block = block_of(shingles, blocks)
        if len(hot):
            near = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
            dealt = np.frombuffer(b"".join(sets), np.uint64)[::2] % np.uint64(HOT_BLOCKS)
            found = hot[near] == shingles
            block = np.where(found, -1 - dealt.astype(np.int64)[owner], block)
            shingles = np.where(found, near.astype(np.uint64), shingles)
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        rows = [_cell(int(block[part[0]]), sigs, sizes, owner[part], shingles[part]) for part in np.split(order, cuts)]
        yield from pa.Table.from_pylist(rows, CELL_SCHEMA).to_batches(max_chunksize=1 << 12)


CELL_SCHEMA = pa.schema([("block", pa.int32()), *((c, pa.binary()) for c in ("sigs", "sizes", "counts", "shingles", "held"))])


def _column_block(table: pa.Table, blocks: int, names: np.ndarray) -> pa.Table:
    """Entries of columns with two rows at least, with the number of rows, dealt to row blocks."""
    block = table.column("block")[0].as_py()
    hot = block < 0
    sigs, sizes, owner, shingles, _ = _entries(table)
    shingles = names[shingles.astype(np.int64)] if hot else column_names(shingles, block, blocks)
    order = np.lexsort((owner, shingles))
    owner, shingles = owner[order], shingles[order]
    new = np.ones(len(order), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    owner, shingles = owner[new], shingles[new]
    first = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    held = np.repeat(np.diff(np.append(first, len(shingles))), np.diff(np.append(first, len(shingles))))
    if hot:
        held = np.full(len(held), LAST)
    keep = held > 1
    owner, shingles, held = owner[keep], shingles[keep], held[keep]
    dealt = (np.frombuffer(sigs.tobytes(), np.uint64)[::2] % np.uint64(blocks)).astype(np.int64)[owner]
    order = np.lexsort((owner, dealt))
    cuts = np.flatnonzero(np.diff(dealt[order])) + 1
    rows = [_cell(int(dealt[p[0]]), sigs, sizes, owner[p], shingles[p], held[p]) for p in np.split(order, cuts) if len(p)]
    return pa.Table.from_pylist(rows, CELL_SCHEMA)


def _row_block(table: pa.Table, percent: int) -> pa.Table:
    """Rows that have a shared column within their bound, with all their shared columns in order."""
    sigs, sizes, owner, shingles, held = _entries(table)
    order = np.lexsort((shingles, held, owner))
    bounds = np.searchsorted(owner[order], np.arange(len(sigs) + 1))
    shingles = shingles[order].view(np.int64)
    n = sizes.astype(np.int64)
    alone = n - np.diff(bounds)
    prefix = n + (-percent * n) // 100 + 1
    rows = np.flatnonzero(alone < prefix)
    return pa.table(
        {
            "sig": pa.array([sigs[k].tobytes() for k in rows], pa.binary()),
            "n": pa.array(n[rows], pa.int64()),
            "alone": pa.array(alone[rows], pa.int64()),
            "prefix": pa.array(prefix[rows], pa.int64()),
            "shingles": pa.array([shingles[bounds[k] : bounds[k + 1]] for k in rows], pa.list_(pa.int64())),
        }
    )


def matrix(docs: DataFrame, hot: DataFrame, entries: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(sig, n, alone, prefix, shingles) of the rows that can have a partner."""
    # bounded: columns of more than one in HOT_SHARE rows number HOT_SHARE times the mean set size at most
    names = np.sort(np.array([r[0] for r in hot.collect()], np.int64).view(np.uint64))
    blocks = max(32, -(-entries // CELL))
    cells = docs.select(F.col("text").cast("string")).mapInArrow(partial(_to_cells, width=width, blocks=blocks, hot=names), CELLS)
    by_row = cells.groupBy("block").applyInArrow(lambda t: _column_block(t, blocks, names), CELLS)
    return by_row.groupBy("block").applyInArrow(
        lambda t: _row_block(t, percent), "sig binary, n bigint, alone bigint, prefix bigint, shingles array<bigint>"
    )


def _bound(percent: int) -> str:
    """Whether rows x and y that first meet at these places can still agree."""
    return f"{100 + percent} * least(x.n - x.place, y.n - y.place) >= {percent} * (x.n + y.n)"


def _multiply(rows: pa.Table, pairs: pa.Table, percent: int) -> pa.Table:
    """The product of a tile at its pairs: (a, b, overlap) of those that agree.

    Rows are numbered, columns too; an entry is row * columns + column, all entries one sorted array. Of the pairs still open, the
    entries of a in a column block are looked up among those of b and counted.
    """
    sets = rows.column("shingles").combine_chunks()
    flat = sets.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))
    size = rows.column("n").to_numpy()
    columns, at = np.unique(flat, return_inverse=True)
    width = len(columns) + 1
    entries = np.sort(np.repeat(np.arange(len(size)), np.diff(ends, prepend=0)) * width + at)
    # an id that unlike texts share stands for several rows
    named = pd.DataFrame({"id": rows.column("id").to_numpy(), "row": np.arange(len(size))})
    met = pairs.select(["a", "b"]).to_pandas().merge(named, left_on="a", right_on="id").merge(named, left_on="b", right_on="id")
    x, y = met["row_x"].to_numpy(), met["row_y"].to_numpy()
    overlap, live = np.zeros(len(met), np.int64), np.arange(len(met))
    cuts = np.arange(SLABS + 1) * width // SLABS
    for low, high in itertools.pairwise(cuts.tolist()):
        begin, stop = np.searchsorted(entries, x[live] * width + low), np.searchsorted(entries, x[live] * width + high)
        n = stop - begin
        done = np.cumsum(n)
        part = 0
        while part < len(live):
            last = max(part + 1, int(np.searchsorted(done, done[part] - n[part] + STEP, "right")))
            own, many = live[part:last], n[part:last]
            place = np.arange(many.sum()) + np.repeat(begin[part:last] - (np.cumsum(many) - many), many)
            look = entries[place] + np.repeat((y[own] - x[own]) * width, many)
            hit = entries[np.minimum(np.searchsorted(entries, look), len(entries) - 1)] == look
            overlap[own] += np.bincount(np.repeat(np.arange(len(own)), many)[hit], minlength=len(own))
            part = last
        left = np.minimum(ends[x[live]] - stop, ends[y[live]] - np.searchsorted(entries, y[live] * width + high))
        live = live[(100 + percent) * (overlap[live] + left) >= percent * (size[x[live]] + size[y[live]])]
    return pa.table({"a": met["a"].to_numpy()[live], "b": met["b"].to_numpy()[live], "overlap": overlap[live]})


def _product(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap, counted in full, is large enough, with the overlap."""
    pairs = stage_table(pairs.distinct(), "met")
    n = rows.select("id", F.size("shingles").alias("k"))
    entries = pairs.select(F.col("a").alias("id")).join(n, "id").agg(F.sum("k")).first()[0] or 0
    tiles = max(1, -(-2 * entries // CELL))
    many = small(pairs.groupBy("b").agg(F.count("*").alias("k")).where(F.col("k") > SPLIT))
    part = F.pmod(F.xxhash64("a"), F.ceil(F.coalesce("k", F.lit(1)) / SPLIT))
    dealt = pairs.join(many, "b", "left").select("a", "b", F.pmod(F.xxhash64("b", part), F.lit(tiles)).alias("tile"))
    needed = dealt.select(F.col("tile").alias("slot"), F.explode(F.array("a", "b")).alias("id")).distinct().join(rows.select("id", "n", "shingles"), "id")
    grouped = needed.groupBy("slot").cogroup(dealt.groupBy("tile"))
    return grouped.applyInArrow(lambda r, p: _multiply(r, p, percent), "a bigint, b bigint, overlap bigint")


def _star(places: DataFrame, percent: int) -> DataFrame:
    """Rows of a part of a column against the part's first row and against the column's first; ``b`` is the first.

    Rows of a part may all be nearer to the column's first than to their own, so each meets both: two pairs a place at most.
    """
    firsts = places.groupBy("shingle", "part").agg(F.min(F.struct("place", "n", "id")).alias("own"))
    column = firsts.groupBy("shingle").agg(F.min("own").alias("whole"))
    firsts = firsts.join(column, "shingle").select("shingle", "part", F.explode(F.array_distinct(F.array("own", "whole"))).alias("y"))
    x = places.select("shingle", "part", F.struct("place", "n", "id").alias("x"))
    met = x.join(firsts, ["shingle", "part"]).where(f"x.id <> y.id and {_bound(percent)}")
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _open(places: DataFrame, percent: int) -> DataFrame:
    """Places that may still meet a row of another component; ``most`` is the column's main component."""
    per = places.groupBy("shingle", "component").agg(F.count("*").alias("k"), F.min("n").alias("low"))
    column = (
        per.groupBy("shingle")
        .agg(F.max_by("component", F.struct("k", "component")).alias("most"), F.min("low").alias("low"), F.count("*").alias("kinds"))
        .where("kinds > 1")
        .select("shingle", "most", "low")
    )
    column = places.select("shingle", "part").distinct().join(column, "shingle")
    smallest = f"greatest(low, ceil({percent} * n / 100))"
    left = places.drop("most").join(column, ["shingle", "part"])
    return left.where(f"{100 + percent} * (n - place) >= {percent} * (n + {smallest})").drop("low")


def _meet(x: DataFrame, places: DataFrame, apart: str, percent: int) -> DataFrame:
    """All pairs of a row of ``x`` and one of ``places`` that share a column, ``apart``: x goes to every part of its column."""
    parts = places.select("shingle", "part").distinct()
    x, y = x.drop("part").join(parts, "shingle").alias("x"), places.alias("y")
    return x.join(y, ["shingle", "part"]).where(f"{apart} and {_bound(percent)}").select(F.col("y.id").alias("a"), F.col("x.id").alias("b"))


def _rest(places: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components: rows outside a column's main component against every row."""
    return _meet(places.where("component <> most"), places, "x.component <> y.component and (y.component = y.most or x.id < y.id)", percent)


def _prepare(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sets per document, classes of equal sets (sig, id, n, copies), rows of the matrix, and the places where rows meet."""
    sets = stage_table(describe(docs, width), "shingle-sets")
    classes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.count("*").alias("copies"))
    found = classes.agg(F.sum("n"), F.count("*")).first()
    total = sets.count()
    hot = sets.select(F.explode("hot").alias("h")).groupBy("h.shingle").agg(F.sum("h.n").alias("n")).where(F.col("n") * HOT_SHARE >= total)
    rows = matrix(docs, hot.select("shingle"), int(found[0] or 0), width, percent)
    rows = stage_table(rows.join(classes.select("sig", "id"), "sig").where("id is not null").drop("sig"), "shingle-rows")
    cut = rows.select("id", "n", "alone", F.posexplode(F.slice("shingles", F.lit(1), (F.col("prefix") - F.col("alone")).cast("int"))).alias("i", "shingle"))
    parts = max(1, math.isqrt(found[1]))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")
    return sets, classes, rows, cut.select("id", "n", "shingle", part, (F.col("alone") + F.col("i")).alias("place"))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text, any other columns).

    Rows link when 100 * overlap >= percent * union of their shingle sets; the component is the
    smallest doc_id that links reach. A null or empty text, or one without words, has no shingle and
    links with nothing: it is its own component. Equal texts, repeated rows and equal doc_ids share a
    component, and each row of the input gives one row. A null doc_id stays null and never names a
    component. Ids are read as whole numbers; text ids raise. An empty table gives no rows.
    """
    sets, classes, rows, places = _prepare(docs, width, percent)
    links = stage_table(_product(_star(places, percent), rows, percent).select("a", "b"), "star-links")
    labelled = places.join(components(links).withColumnRenamed("component", "c"), "id", "left").select(
        "id", "n", "shingle", "part", "place", F.coalesce("c", "id").alias("component")
    )
    left = stage_table(_open(_open(labelled, percent), percent), "open-places")
    more = _product(_rest(left, percent), rows, percent).select("a", "b")
    linked = components(links.unionByName(more))
    named = classes.select("sig", "id").join(linked, "id", "left").select("sig", F.coalesce("component", "id").alias("component"))
    return sets.join(named, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def jaccard_links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every link between different texts, and what each document belongs to; rules as in ``jaccard_components``.

    Links are (a, b, overlap) with a < b, ids of classes of equal shingle sets. Members are (doc_id, n_shingles, class_id,
    n_links) per row of ``docs``: the class is named by its smallest doc_id, n_links counts the other rows that the row links with,
    copies included. Rows without words have no class and no link. A class without any doc_id has a null name and links among
    its copies only. Ids that unlike texts share have to be told apart beforehand, or stand for all of these texts.

    The links of a group of unlike texts grow with its square; components need no such product.
    """
    sets, classes, rows, places = _prepare(docs, width, percent)
    met = _meet(places, places, "x.id < y.id", percent)
    links = stage_table(_product(met, rows, percent).select(F.col("b").alias("a"), F.col("a").alias("b"), "overlap").distinct(), "links-of-classes")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    reach = ends.join(classes.select(F.col("id").alias("b"), "copies"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("reached"))
    named = classes.join(reach, "id", "left").select("sig", F.col("id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("reached", F.lit(0))).alias("k"))
    members = sets.join(named, "sig", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("k", F.lit(0)).alias("n_links"))
    return members, links
