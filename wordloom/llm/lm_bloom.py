"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts of words and word pairs are quantised to levels of doubling counts. A pair of level q is put
into a Bloom filter as (pair, 1) to (pair, q); a count is read back by probing levels upwards until one
is missing. The probability of a word after another is a fixed mix of the pair's share of the first
word's count and the word's own smoothed share.

Counting is blocked by key hash: a task sends the distinct keys of a batch and their counts as
packed numbers, and each block is summed by numpy. Every word and pair is stored, whatever its count, so the
filter grows with the input. It is broadcast up to ``MAX_BYTES``, by a histogram of all counts; beyond that each block
of it meets the distinct keys of the texts' pieces in a shuffle, with the same scores. Base scores use exact counts: those
of the most frequent words are broadcast (at most ``HOT``), all others meet their texts in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import fold, mix, slices, word_hashes
from wordloom.session import stage_table

#: Bits per stored level and hash functions: about one false hit in a hundred.
BITS, HASHES = 10, 7
#: Largest filter that is broadcast.
MAX_BYTES = 128 << 20
#: Weight of the pair's share.
PAIR_WEIGHT = 0.4
#: Most words whose exact counts are broadcast.
HOT = 1 << 19
#: Mean number of tokens per block.
CELL = 1 << 21
END, BEGIN = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A35)
WORD, PAIR = 0, 1

COUNTS = "kind int, block int, keys binary, counts binary"
COUNT_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def level(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return np.frexp(counts.astype(np.float64))[1]


def estimate(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts, 0 for level 0."""
    return np.where(levels > 0, (3 * np.exp2(levels - 1) - 1) / 2, 0)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens and of the pairs they end, and the number of tokens per row; an end closes each row."""
    hashes, per_row = word_hashes(column)
    ends = np.cumsum(per_row + 1) - 1
    words = np.empty(len(hashes) + len(per_row), np.uint64)
    inner = np.ones(len(words), bool)
    inner[ends] = False
    words[inner], words[ends] = hashes, END
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[ends - per_row] = BEGIN
    both = np.stack([before, words], 1).reshape(-1)
    return words, fold(both, 2)[::2] if len(both) else words, per_row + 1


def _by_block(keys: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each block that holds some of the keys, in order: its number, its keys and their places."""
    block = (keys % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    return ((int(block[p[0]]), keys[p], p) for p in np.split(order, cuts) if len(p))


def _packed(kind: int, keys: np.ndarray, counts: np.ndarray, blocks: int) -> list[dict]:
    return [{"kind": kind, "block": block, "keys": part.tobytes(), "counts": counts[p].astype(np.uint32).tobytes()} for block, part, p in _by_block(keys, blocks)]


def _count(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, 1 << 22):
            words, pairs, _ = tokens(piece.column(0))
            rows = [row for kind, keys in ((WORD, words), (PAIR, pairs)) for row in _packed(kind, *np.unique(keys, return_counts=True), blocks)]
            yield from pa.Table.from_pylist(rows, COUNT_SCHEMA).to_batches(max_chunksize=1 << 10)


SUMS = "kind int, block int, keys binary, counts binary, n bigint, distinct bigint, levels array<bigint>"


def _sum(table: pa.Table) -> pa.Table:
    """The keys of one block with the exact counts of words and the levels of pairs, a byte each, and the number of keys per level."""
    kind, block = table.column("kind")[0].as_py(), table.column("block")[0].as_py()
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    part = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.add.reduceat(part[order].astype(np.int64), first)
    keys, levels = keys[first], level(counts)
    row = {"kind": kind, "block": block, "keys": keys.tobytes(), "counts": counts.tobytes() if kind == WORD else levels.astype(np.uint8).tobytes(), "n": int(counts.sum()), "distinct": len(keys), "levels": np.bincount(levels, minlength=64).tolist()}
    return pa.Table.from_pylist([row], SUM_SCHEMA)


SUM_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("distinct", pa.int64()), ("levels", pa.list_(pa.int64()))])


def level_hash(keys: np.ndarray, at: np.ndarray | int) -> np.ndarray:
    return mix(keys + np.asarray(at, np.uint64) * np.uint64(0xA0761D6478BD642F))


def place(h: np.ndarray, k: int, bits: np.ndarray) -> np.ndarray:
    """Where hash function ``k`` puts a (key, level) in a filter of ``bits`` bits."""
    one, two = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((one + np.uint64(k) * two & np.uint64(0xFFFFFFFF)) * bits) >> np.uint64(32)


def _build(batches: Iterator[pa.RecordBatch], low: int = 1) -> Iterator[pa.RecordBatch]:
    """The filter of each block of counts, ``BITS`` bits per stored level."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            keys = np.frombuffer(row["keys"], np.uint64)
            levels = level(np.frombuffer(row["counts"], np.int64)) if row["kind"] == WORD else np.frombuffer(row["counts"], np.uint8).astype(np.int64)
            n = np.maximum(0, levels - low + 1)
            places = np.repeat(keys, n)
            steps = np.arange(len(places)) - np.repeat(np.cumsum(n) - n, n) + low
            size = max(64, -(-len(places) * BITS // 64) * 64)
            flags = np.zeros(size, bool)
            h = level_hash(places, steps)
            for k in range(HASHES):
                flags[place(h, k, np.uint64(size)).astype(np.int64)] = True
            yield pa.RecordBatch.from_pylist([{"kind": row["kind"], "block": row["block"], "bits": np.packbits(flags).tobytes()}], FILTER_SCHEMA)


FILTERS = "kind int, block int, bits binary"
FILTER_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("bits", pa.binary())])


class Filter:
    """The blocks of a filter end to end."""

    def __init__(self, parts: list[bytes], low: int = 1):
        sizes = np.array([len(p) * 8 for p in parts], np.uint64)
        self.low, self.sizes, self.begin = low, sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
        self.bits = np.frombuffer(b"".join(parts), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: probes go on while all places of the next level are set."""
        block = (keys % np.uint64(len(self.sizes))).astype(np.int64)
        found, live, at = np.zeros(len(keys), np.int64), np.arange(len(keys)), self.low
        while len(live):
            h = level_hash(keys[live], at)
            for k in range(HASHES):  # each hash function only sees what passed the one before
                spot = self.begin[block[live]] + place(h, k, self.sizes[block[live]])
                there = np.flatnonzero(self.bits[(spot >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (spot & np.uint64(7))).astype(np.uint8) & 1)
                live, h = live[there], h[there]
            found[live] = at
            at += 1
        return found


def log_probabilities(words: np.ndarray, pairs: np.ndarray, per_row: np.ndarray, n: int, distinct: int, texts: int) -> np.ndarray:
    """log10 of each token's probability after the token before it, from the levels of its word and pair."""
    count, pair = estimate(words), estimate(pairs)
    before = np.empty_like(count)
    before[1:] = count[:-1]
    before[np.cumsum(per_row) - per_row] = texts
    share = np.where(before > 0, np.minimum(1, pair / np.maximum(before, 1)), 0)
    return np.log10(PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * (count + 1) / (n + distinct + 1))


class Model:
    """What scoring needs: both filters if they are broadcast, the exact counts of hot words and the totals."""

    def __init__(self, words: Filter | None, pairs: Filter | None, hot_keys: np.ndarray, hot_counts: np.ndarray, n: int, distinct: int, texts: int):
        self.words, self.pairs, self.hot_keys, self.hot_counts = words, pairs, hot_keys, hot_counts
        self.n, self.distinct, self.texts = n, distinct, texts

    def log_probabilities(self, words: np.ndarray, pairs: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the token before it."""
        levels = []
        for held, keys in ((self.words, words), (self.pairs, pairs)):
            known, back = np.unique(keys, return_inverse=True)
            levels.append(held.levels(known)[back])
        return log_probabilities(*levels, per_row, self.n, self.distinct, self.texts)

    def hot(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of hot words, 0 for others."""
        if not len(self.hot_keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.hot_keys, keys), len(self.hot_keys) - 1)
        return np.where(self.hot_keys[at] == keys, self.hot_counts[at], 0)


def _counted(texts: DataFrame, blocks: int) -> DataFrame:
    packed = texts.mapInArrow(partial(_count, blocks=blocks), COUNTS)
    return stage_table(packed.groupBy("kind", "block").applyInArrow(lambda t: _sum(t), SUMS), "ngram-counts")


def _histogram(counts: DataFrame, kind: int) -> np.ndarray:
    """Keys per level, 64 numbers."""
    rows = counts.where(F.col("kind") == kind).select(F.posexplode("levels").alias("level", "k")).groupBy("level").agg(F.sum("k").alias("k")).collect()
    out = np.zeros(64, np.int64)
    for r in rows:
        out[r["level"]] = r["k"]
    return out


def _filter_bytes(per_level: np.ndarray, blocks: int) -> int:
    """Most bytes that a filter of all levels takes, each block rounded up to 8."""
    return sum(q * int(k) for q, k in enumerate(per_level)) * BITS // 8 + 16 * blocks


def _hot_words(counts: DataFrame, per_level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of all words from the lowest level on that leaves at most ``HOT``."""
    low = next(q for q in range(1, 65) if per_level[q:].sum() <= HOT)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, n = np.frombuffer(keys, np.uint64), np.frombuffer(n, np.int64)
                keep = level(n) >= low
                yield pa.RecordBatch.from_arrays([pa.array([keys[keep].tobytes()]), pa.array([n[keep].tobytes()])], ["keys", "counts"])

    rows = counts.where(F.col("kind") == WORD).select("keys", "counts").mapInArrow(pick, "keys binary, counts binary").collect()  # at most HOT words
    keys = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64)
    order = np.argsort(keys)
    return keys[order], np.frombuffer(b"".join(r["counts"] for r in rows), np.int64)[order]


SCORES = "doc_id bigint, row bigint, n_tokens bigint, known bigint, base double, score double, block int, rows binary, keys binary, kind int, piece bigint, text string"
SCORE_SCHEMA = pa.schema([(n, {"bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}[k]) for n, k in (c.split() for c in SCORES.split(", "))])


def _score(batches: Iterator[pa.RecordBatch], shared: Broadcast, blocks: int) -> Iterator[pa.RecordBatch]:
    """One row per text, and per block one packed row of the words whose exact counts are not at hand.

    Without a filter at hand texts have no score yet but the piece they are in, and there is one packed row
    per piece, kind and block of the distinct keys whose levels are asked for.
    """
    model = shared.value
    for batch in batches:
        for piece in slices(batch):
            words, pairs, per_row = tokens(piece.column(2))
            begin = np.cumsum(per_row) - per_row
            counts = model.hot(words)
            add = lambda x: np.add.reduceat(x, begin) if len(x) else x
            ids = piece.column(1).to_numpy()
            done = {"doc_id": piece.column(0), "row": ids, "n_tokens": per_row, "known": add((counts > 0).astype(np.int64)), "base": add(np.log10(counts + 1.0))}
            if model.words is not None:
                done["score"] = add(model.log_probabilities(words, pairs, per_row))
            else:
                done |= {"piece": np.full(len(ids), ids[0]), "text": piece.column(2)}
                for kind, keys in ((WORD, words), (PAIR, pairs)):
                    rows = [{"piece": int(ids[0]), "kind": kind, "block": block, "keys": part.tobytes()} for block, part, _ in _by_block(np.unique(keys), blocks)]
                    yield from pa.Table.from_pylist(rows, SCORE_SCHEMA).to_batches(max_chunksize=1 << 10)
            yield pa.RecordBatch.from_arrays([(done[f.name] if f.name in ("doc_id", "text") else pa.array(done[f.name], f.type)) if f.name in done else pa.nulls(len(ids), f.type) for f in SCORE_SCHEMA], schema=SCORE_SCHEMA)
            cold = np.flatnonzero(counts == 0)
            owner = np.repeat(np.arange(len(ids)), per_row)[cold]
            block = (words[cold] % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            rows = [
                {"block": int(block[p[0]]), "rows": ids[owner[p]].tobytes(), "keys": words[cold[p]].tobytes()}
                for p in np.split(order, np.flatnonzero(np.diff(block[order])) + 1)
                if len(p)
            ]
            yield from pa.Table.from_pylist(rows, SCORE_SCHEMA).to_batches(max_chunksize=1 << 10)


def _look_up(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """Of one block, what each text's words add to its known tokens and base score."""
    join = lambda table, name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    rows, keys = join(asked, "rows", np.int64), join(asked, "keys", np.uint64)
    known, n = join(counts, "keys", np.uint64), join(counts, "counts", np.int64)
    order = np.argsort(known)
    known, n = known[order], n[order]
    at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
    found = np.where(known[at] == keys, n[at], 0) if len(known) else np.zeros(len(keys), np.int64)
    hit = found > 0
    ids, back = np.unique(rows[hit], return_inverse=True)
    add = lambda x: np.bincount(back, x, len(ids))
    return pa.table({"row": ids, "more_known": add(np.ones(hit.sum())).astype(np.int64), "more_base": add(np.log10(found[hit] + 1.0)).astype(np.float64)})


def _probe(asked: pa.Table, filters: pa.Table) -> pa.Table:
    """The levels of the keys that each piece asks one block for; a block without a filter holds none."""
    held = Filter(filters.column("bits").to_pylist() or [bytes(8)])
    keys = asked.column("keys").to_pylist()
    found = held.levels(np.frombuffer(b"".join(keys), np.uint64)).astype(np.uint8)
    ends = np.cumsum([len(k) // 8 for k in keys], dtype=np.int64)
    levels = [part.tobytes() for part in np.split(found, ends[:-1])] if keys else []
    return pa.table({"piece": asked.column("piece"), "kind": asked.column("kind"), "block": asked.column("block"), "levels": pa.array(levels, pa.binary())})


def _score_piece(texts: pa.Table, answers: pa.Table, blocks: int, n: int, distinct: int, trained: int) -> pa.Table:
    """(row, score) of one piece's texts from the levels that the blocks gave."""
    words, pairs, per_row = tokens(texts.column("text"))
    held = {(a["kind"], a["block"]): a["levels"] for a in answers.to_pylist()}
    levels = []
    for kind, keys in ((WORD, words), (PAIR, pairs)):
        known, back = np.unique(keys, return_inverse=True)
        found = np.zeros(len(known), np.int64)
        for block, _, places in _by_block(known, blocks):
            found[places] = np.frombuffer(held[kind, block], np.uint8)
        levels.append(found[back])
    logs = log_probabilities(*levels, per_row, n, distinct, trained)
    return pa.table({"row": texts.column("row"), "score": np.add.reduceat(logs, np.cumsum(per_row) - per_row)})


def _scores_by_block(scored: DataFrame, filters: DataFrame, blocks: int, n: int, distinct: int, trained: int) -> DataFrame:
    """(row, score) of the texts whose pieces asked for levels: each block answers, then each piece is scored."""
    asked = scored.where("kind is not null").select("piece", "kind", "block", "keys")
    answers = asked.groupBy("kind", "block").cogroup(filters.groupBy("kind", "block")).applyInArrow(lambda a, f: _probe(a, f), "piece bigint, kind int, block int, levels binary")
    texts = scored.where("block is null").select("piece", "row", "text")
    return texts.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(lambda t, a: _score_piece(t, a, blocks, n, distinct, trained), "row bigint, score double")


def scores(docs: DataFrame, training: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id, text, any other columns).

    ``training`` tells the rows that the model learns from. A null text counts as empty: its one token
    is the end. Without training rows every probability is the same. Repeated rows count and are
    scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), training.alias("training"))
    size = texts.agg(F.sum(F.octet_length("text")), F.count_if("training")).first()
    blocks = int(max(32, (size[0] or 0) // 6 // CELL))
    counts = _counted(texts.where("training").select("text"), blocks)
    totals = counts.where(F.col("kind") == WORD).agg(F.sum("n"), F.sum("distinct")).first()
    n, distinct = int(totals[0] or 0), int(totals[1] or 0)
    per_word, per_pair = _histogram(counts, WORD), _histogram(counts, PAIR)
    trained = int(size[1] or 0)
    filters = counts.select("kind", "block", "keys", "counts").mapInArrow(_build, FILTERS)
    at_hand = _filter_bytes(per_word, blocks) + _filter_bytes(per_pair, blocks) <= MAX_BYTES
    both = [None, None]
    if at_hand:
        built = {(r["kind"], r["block"]): r["bits"] for r in filters.collect()}  # at most MAX_BYTES
        both = [Filter([built.get((kind, b), bytes(8)) for b in range(blocks)]) for kind in (WORD, PAIR)]
        del built
    model = spark.sparkContext.broadcast(Model(*both, *_hot_words(counts, per_word), n, distinct, trained))
    rows = texts.select(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id(), "text")
    scored = stage_table(rows.mapInArrow(partial(_score, shared=model, blocks=blocks), SCORES), "scores")
    model.destroy()  # what it was for is staged
    asked = scored.where("block is not null and kind is null").select("block", "rows", "keys")
    exact = counts.where(F.col("kind") == WORD).select("block", "keys", "counts")
    found = asked.groupBy("block").cogroup(exact.groupBy("block")).applyInArrow(lambda a, c: _look_up(a, c), "row bigint, more_known bigint, more_base double")
    more = found.groupBy("row").agg(F.sum("more_known").alias("more_known"), F.sum("more_base").alias("more_base"))
    of_texts = scored.where("block is null")
    if not at_hand:
        of_texts = of_texts.drop("score").join(_scores_by_block(scored, filters, blocks, n, distinct, trained), "row")
    of_texts = of_texts.join(more, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return of_texts.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + zero("more_known")).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + zero("more_base") - F.col("n_tokens") * float(np.log10(n + distinct + 1))).alias("base_score"),
        "score",
    )
