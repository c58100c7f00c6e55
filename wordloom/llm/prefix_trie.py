"""A prefix trie of rebuilt conversations from composable fingerprints.

A conversation is rebuilt as the first h turns of its base conversation and its own turns after its first
h. No rebuilt text is ever made: a turn is a digest, its place and its length, and a sequence of turns has the
fingerprint sum of digest x B ** place modulo four primes, the product of its turns in a
monoid, so the fingerprint of base head and own suffix follows from sums that each conversation has by
itself. Rows of the trie carry numbers only, beside the reference (conversation, place) to the stored turn.

A node is a group of equal (depth, fingerprint). Its members' last turns are verified to be equal by their stored
SHA-256; as members of a group lie in one group at each smaller depth as well, whole prefixes are
then equal. If a group were mixed, another base B is taken.

What a node sums over its subtree is summed over its members instead, without walking the tree. Each
node is owned by its smallest member, and a member owns the nodes of its path from some depth on. Leaves of the subtree
are the members that own a leaf; the sum of (members - 1) x length over the nodes below is the sum, over the
members, of the lengths of their turns between the node and the first node they own.

Long conversations are split: rows are sorted by range and cut into blocks of ``BLOCK`` rows, sums
run within a block, and block totals carry them on, so a conversation may hold any share of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.ranking import with_position
from wordloom.session import stage_table

#: Conversations of one family share the head of the one whose id it is a multiple of.
FAMILY = 100
#: Heads are shorter than this.
HEADS = 6
#: Rows of one block of a long conversation.
BLOCK = 1 << 16
#: Copies of the parents that children are dealt over, so that a parent of many children is no hot key.
SALTS = 16
#: Ids that one piece of a node's id list holds.
CHUNK = 1 << 14

# The four largest primes below 2 ** 31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = range(len(PRIMES))
BASES = (1_000_003, 16_777_619, 48_271)


def head_length(conv_id: str | Column) -> Column:
    return F.pmod(F.crc32(F.col(conv_id).cast("string") if isinstance(conv_id, str) else conv_id), F.lit(HEADS))


def _digest() -> Column:
    """SHA-256 of role and text, told apart by the role's length; null is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _with_terms(rows: DataFrame, base: int) -> DataFrame:
    """Add ``t0`` .. ``t3``: digest x base ** place modulo each prime; map-only."""
    primes = np.array(PRIMES, np.uint64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("digest").cast(pa.binary(32))
            words = np.frombuffer(digests.buffers()[1], ">u4", 8 * len(digests), 32 * digests.offset).reshape(-1, 8)
            place = batch.column("place").to_numpy().copy()
            x = words[:, : len(PRIMES)].astype(np.uint64) % primes
            power = np.full(len(PRIMES), base, np.uint64) % primes
            while place.any():
                x = np.where((place & 1)[:, None] == 1, x * power % primes, x)
                power = power * power % primes
                place >>= 1
            terms = [pa.array(x[:, k].astype(np.int64)) for k in LANES]
            yield pa.record_batch([*batch.columns, *terms], names=[*batch.schema.names, *(f"t{k}" for k in LANES)])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(task, f"{schema}, " + ", ".join(f"t{k} bigint" for k in LANES))


def _packed(lanes: list[Column]) -> list[Column]:
    """Four numbers below 2 ** 31 as two."""
    return [lanes[0] * F.lit(1 << 31) + lanes[1], lanes[2] * F.lit(1 << 31) + lanes[3]]


def _modulo(lanes: list[Column]) -> list[Column]:
    return [F.pmod(lane, F.lit(p)) for lane, p in zip(lanes, PRIMES)]


def _placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in their conversation, and one row per conversation.

    (conv_id, block, place, digest, chars, at) and (conv_id, first, n, head). Both are staged.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    small = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _digest().alias("digest"), F.length(text).cast("long").alias("chars")
    )
    rows = stage_table(with_position(small, [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")], "at", 0), "turns")
    convs = rows.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    convs = stage_table(convs.withColumn("head", head_length("conv_id").cast("long")), "conversations")
    spans = convs.withColumn("block", F.explode(_blocks())).select("conv_id", "block", "first")
    rows = rows.withColumn("block", _block(F.col("at"))).join(spans, ["conv_id", "block"])
    return rows.withColumn("place", F.col("at") - F.col("first")).drop("first", "turn"), convs


def _block(at: Column) -> Column:
    return F.floor(at / BLOCK).cast("long")


def _blocks() -> Column:
    """The blocks that hold rows of a conversation."""
    return F.sequence(_block(F.col("first")), _block(F.col("first") + F.col("n") - 1))


def _heads(rows: DataFrame, base: int) -> DataFrame:
    """(base_id, n_head, path): the first turns of each base conversation, five at most, each with the sums up to it."""
    first = _with_terms(rows.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1)), base)
    turn = F.struct("place", "digest", "chars", *(f"t{k}" for k in LANES))
    path = F.sort_array(F.collect_list(turn)).alias("path")  # at most HEADS - 1 turns
    return first.groupBy(F.col("conv_id").alias("base_id")).agg(path).withColumn("n_head", F.size("path").cast("long"))


def _sum_of(path: Column, n: Column, field: str) -> Column:
    """The sum of a field over the first ``n`` turns of a head."""
    return F.aggregate(F.slice(path, F.lit(1), n.cast("int")), F.lit(0).cast("long"), lambda a, x: a + x[field])


def _members(turns: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """Every rebuilt conversation at every depth, and one row per conversation.

    (conv_id, block, depth, f, g, pf, pg, digest, chars, before, own): the fingerprint in two numbers, that of the prefix one
    shorter, the last turn and the characters before it. (conv_id, first, n, length, chars).
    """
    rows, convs = _placed(turns)
    heads = stage_table(_heads(rows, base), "heads")
    convs = convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base_id", "left")
    kept = F.least("head", F.coalesce("n_head", F.lit(0)))
    empty = F.array().cast(heads.schema["path"].dataType)
    convs = convs.withColumn("kept", kept).withColumn("path", F.slice(F.coalesce("path", empty), F.lit(1), kept.cast("int"))).drop("n_head")
    convs = stage_table(convs.withColumn("length", F.col("kept") + F.greatest(F.lit(0), F.col("n") - F.col("head"))), "heads-of")

    path = F.col("path")
    sums = [_sum_of(path, F.col("kept"), f"t{k}").alias(f"s{k}") for k in LANES]
    spans = convs.withColumn("block", F.explode(_blocks()))
    spans = spans.select("conv_id", "block", "head", "kept", _sum_of(path, F.col("kept"), "chars").alias("head_chars"), *sums)
    own = rows.join(spans, ["conv_id", "block"]).where("place >= head").withColumn("place", F.col("kept") + F.col("place") - F.col("head"))
    own = stage_table(_with_terms(own, base), "own")
    added = ["chars", *(f"t{k}" for k in LANES)]
    totals = own.groupBy("conv_id", "block").agg(*(F.sum(c).alias(f"all_{c}") for c in added))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", *(F.coalesce(F.sum(f"all_{c}").over(earlier), F.lit(0)).alias(f"of_{c}") for c in added))
    running = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = {c: F.sum(c).over(running) + F.col(f"of_{c}") for c in added}
    now = _modulo([upto[f"t{k}"] + F.col(f"s{k}") for k in LANES])
    own = own.join(carried, ["conv_id", "block"]).select(
        "conv_id", "block", (F.col("place") + 1).alias("depth"), *(c.alias(f"f{k}") for k, c in enumerate(now)),
        *(f"t{k}" for k in LANES), "digest", "chars", (upto["chars"] - F.col("chars") + F.col("head_chars")).alias("before"),
    )

    at = convs.select("conv_id", _block(F.col("first")).alias("block"), "path", F.posexplode("path").alias("place", "turn"))
    n = F.col("place") + 1
    sums = _modulo([_sum_of(path, n, f"t{k}") for k in LANES])
    before = _sum_of(path, n, "chars") - F.col("turn.chars")
    head = at.select(
        "conv_id", "block", n.cast("long").alias("depth"), *(c.alias(f"f{k}") for k, c in enumerate(sums)),
        *(F.col(f"turn.t{k}").alias(f"t{k}") for k in LANES), "turn.digest", "turn.chars", before.alias("before"),
    )
    lanes = [F.col(f"f{k}") for k in LANES]
    ahead = _modulo([F.col(f"f{k}") - F.col(f"t{k}") for k in LANES])  # without the last turn
    names = ["f", "g", "pf", "pg"]
    numbers = [c.alias(name) for c, name in zip([*_packed(lanes), *_packed(ahead)], names)]
    zero = [F.lit(0).cast("long").alias(name) for name in ["depth", *names]]
    root = convs.select("conv_id", _block(F.col("first")).alias("block"), *zero, F.lit(None).cast("binary").alias("digest"), zero[0].alias("chars"), zero[0].alias("before"))
    below = own.unionByName(head).select("conv_id", "block", "depth", *numbers, "digest", "chars", "before")
    return stage_table(below.unionByName(root), "members"), convs


NODE = ["depth", "f", "g"]


def _nodes(members: DataFrame) -> DataFrame:
    """One row per node with its smallest member; counts are summed per task first."""
    return members.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("pf").alias("pf"), F.min("pg").alias("pg"),
        F.min("chars").alias("chars"), (~F.min("digest").eqNullSafe(F.max("digest"))).alias("mixed"),
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """(depth, f, g, parent_conv_id). A parent of one member has the same one as its child; others are joined over salts."""
    salt = F.pmod(F.xxhash64(*NODE), F.lit(SALTS)).alias("salt")
    child = nodes.where("depth > 0").select(*NODE, (F.col("depth") - 1).alias("up"), "pf", "pg", "conv_id", salt)
    shared = nodes.where("n_convs > 1").select(
        F.col("depth").alias("up"), F.col("f").alias("pf"), F.col("g").alias("pg"), F.col("conv_id").alias("above"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    joined = child.join(shared.withColumn("salt", F.col("salt").cast("long")), ["up", "pf", "pg", "salt"], "left")
    return joined.select(*NODE, F.coalesce("above", "conv_id").alias("parent_conv_id"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(depth, f, g, ends_sha256): of each node's ids in order, from pieces of ``CHUNK`` ids, each made in its own task.

    The ids of a hot node are sorted over many tasks by range; only its finished pieces, bytes in order, are
    streamed through one digest.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, ids = [], None, []
        schema = pa.schema([("depth", pa.int64()), ("f", pa.int64()), ("g", pa.int64()), ("least", pa.int64()), ("ids", pa.binary())])

        def close():
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids)).encode()))
                ids.clear()

        for batch in batches:
            for *node, conv_id in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if node != key or len(ids) >= CHUNK:
                    close()
                    key = node
                ids.append(conv_id)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        close()
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        out, key, running = [], None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in NODE]
            for i, node in enumerate(zip(*columns)):
                piece = batch.column("ids")[i].as_py()
                if node != key:
                    if key is not None:
                        out.append((*key, running.hexdigest()))
                    key, running = node, hashlib.sha256(piece)
                else:
                    running.update(b"," + piece)
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=[*NODE, "ends_sha256"])
                out = []
        if key is not None:
            out.append((*key, running.hexdigest()))
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names=[*NODE, "ends_sha256"])

    ordered = ends.orderBy(*NODE, "conv_id")  # by range: a node of many ids lies in many tasks
    cut = ordered.mapInArrow(pieces, "depth bigint, f bigint, g bigint, least bigint, ids binary")
    whole = cut.repartition(*NODE).sortWithinPartitions(*NODE, "least")
    return whole.mapInArrow(digests, "depth bigint, f bigint, g bigint, ends_sha256 string")


def trie(turns: DataFrame, bases: tuple[int, ...] = BASES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    ``turns`` holds (conv_id, turn, role, text, any other columns). Turns are ordered by ``turn``, null first, those
    of one number by the digest of role and text; repeated rows are turns of their own. Null role or text is empty. Rows
    without a conv_id belong to no conversation and are left out. The root has depth 0, all conversations, and
    no parent; no conversations give no rows.
    """
    for base in bases:
        members, convs = _members(turns, base)
        nodes = stage_table(_nodes(members), "nodes")
        if nodes.where("mixed").isEmpty():
            break
    else:
        raise RuntimeError("unlike turns share a fingerprint under every base")

    up = [(F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("pg").alias("g")]
    children = nodes.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = stage_table(nodes.drop("mixed").join(children, NODE, "left").fillna(0, ["n_children"]), "counted")

    # the first depth that a member owns and whether it owns a leaf; members without a node own none
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("owns"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    owners = convs.select("conv_id", "first", "n", "length").join(owned, "conv_id", "left").withColumn("owns", F.coalesce("owns", F.col("length") + 1))
    spans = owners.withColumn("block", F.explode(_blocks())).select("conv_id", "block", "owns", F.coalesce("leaf", F.lit(0)).alias("leaf"), "length")
    seen = stage_table(members.select("conv_id", "block", *NODE, "chars", "before").join(spans, ["conv_id", "block"]), "seen")
    # characters of a member's turns ahead of the first node it owns
    reach = F.when(F.col("depth") == F.least("owns", "length"), F.col("before") + F.when(F.col("owns") > F.col("length"), F.col("chars")).otherwise(0))
    ahead = seen.select("conv_id", reach.alias("ahead")).where("ahead is not null")
    ahead = convs.select("conv_id", "first", "n").join(ahead, "conv_id").withColumn("block", F.explode(_blocks())).select("conv_id", "block", "ahead")
    saved = F.when(F.col("depth") < F.col("owns"), F.col("ahead") - F.col("before")).otherwise(0)
    below = seen.where("leaf > 0 or depth < owns").join(ahead, ["conv_id", "block"])
    sums = below.groupBy(*NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))

    digests = _end_digests(seen.where("depth = length").select(*NODE, "conv_id"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    joined = nodes.join(sums, NODE, "left").join(digests, NODE, "left").join(_parents(nodes), NODE, "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
