import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wordloom.llm import prefix_trie
from wordloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, note string, depth bigint, f bigint"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv_id].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    head = {c: zlib.crc32(str(c).encode()) % 6 for c in turns}
    return {c: turns.get(int(c / 100) * 100, [])[: head[c]] + ts[head[c] :] for c, ts in turns.items()}


def brute_force(rows):
    paths = rebuilt(rows)
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [out[child] for child in children[node]]
        ends = sorted(c for c in members[node] if len(paths[c]) == len(node))
        out[node] = (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
            sum(b[5] for b in below) or 1, own + sum(b[6] for b in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(out.values())


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(frame).collect())


def corpus(seed):
    rng = random.Random(seed)
    shared = [(rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None, "é" * 5])) for _ in range(9)]
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, 206, 300, -100, -95, -7]:
        length = rng.choice([1, 2, 3, 6, 9])
        turns = [shared[k] if rng.random() < 0.8 else (rng.choice(["user", "bot"]), f"t{rng.randint(0, 3)}") for k in range(length)]
        rows += [(c, None if k == 0 and rng.random() < 0.3 else k, *t) for k, t in enumerate(turns)]
    return [*rows, rows[5], rows[5], (None, 1, "user", "lost"), (400, 2, "a", "tie"), (400, 2, "a", "same"), (400, None, "a", "first")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute_force(rows)


def test_long_conversations_and_id_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = corpus(3) + [(k, t, "u", f"t{t}") for k in (500, 501) for t in range(60)] + [(k, 0, "u", "same") for k in range(600, 640)]
    assert found(spark, rows) == brute_force(rows)


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    made = QUERIES["op13_prefix_trie"](spark, sf)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in made.collect()) == brute_force(rows)


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    short = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(short, 0, "u", "gone")]  # its base is absent and its only turn lies in the head
    assert found(spark, rows) == brute_force(rows) and len(found(spark, rows)) == 1


def test_a_mixed_group_takes_another_base(spark, monkeypatch):
    with pytest.raises(RuntimeError):  # base 0 forgets all turns but the first, as does every base of this list
        prefix_trie.trie(spark.createDataFrame([(c, t, "u", f"{c}{t}") for c in (100, 101, 102, 103, 104) for t in range(7)], "conv_id bigint, turn bigint, role string, text string"), (0,))
