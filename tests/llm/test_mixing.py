import collections
import itertools
import random
import re

import numpy as np
import pytest

from wordloom.llm import mixing


def shares(sizes, weights=mixing.WEIGHTS, most=3):
    """Targets by resharing what capped sources leave until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", "d", "é", None, "tiny"]) if k else "tiny"
        if source == "tiny" and k > 3:
            source = "a"
        rows.append((k, " ".join(f"w{j}" for j in range(rng.choice([0, 1, 3, 10, 10, 10, rng.randint(1, 300)]))), source))
    return [*rows, (1000, None, "a"), (1001, "x " * 5000, "a"), (1002, "x " * 5001, "a")]


def mixed(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(parts)
    return {r.doc_id: r for r in mixing.mix(docs).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_sums(spark, seed):
    rows = corpus(seed)
    found = mixed(spark, rows)
    assert len(found) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for doc_id, text, source in rows:
        r = found[doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and r.source == source
        assert r.taken == r.repeats * r.size and 0 <= r.repeats <= 3
        sizes[source] += r.size
        taken[source] += r.taken
    want = shares(sizes)
    for doc_id, _, source in rows:
        assert found[doc_id].source_size == sizes[source]
        assert found[doc_id].target == pytest.approx(want[source], rel=1e-9, abs=1e-9)
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
        times = [found[k].repeats for k, t, s in rows if s == source and t and t.strip()]
        assert not times or max(times) - min(times) <= 1


def test_a_source_of_one_long_text_comes_as_near_as_it_can(spark):
    rows = [(1, "x " * 100, "a"), (2, "x " * 1000, "b"), (3, "x " * 50, "b"), (4, "x " * 900, "c")]
    found = mixed(spark, rows)
    want = shares({"a": 100, "b": 1050, "c": 900})
    assert {k: r.taken for k, r in found.items()}[1] == 300
    assert want["b"] - 1000 < sum(found[k].taken for k in (2, 3)) <= want["b"] and found[4].taken in (0, 900)


@pytest.mark.parametrize("seed", range(4))
def test_few_long_texts_come_as_near_as_any_number_of_copies_can(spark, seed):
    rng = random.Random(seed)
    rows = [(k, "x " * rng.randint(40, 900), s) for k, s in enumerate("aaaabbbccccd")]
    found = mixed(spark, rows)
    sizes = collections.Counter()
    for k, _, s in rows:
        sizes[s] += found[k].size
    for source, target in shares(sizes).items():
        own = [found[k] for k, _, s in rows if s == source]
        best = best_sum([r.size for r in own], [3] * len(own), round(target))
        assert sum(r.taken for r in own) == best and all(0 <= r.repeats <= 3 for r in own)


def test_reruns_and_partitions_agree(spark):
    rows = corpus(3)
    first, again = mixed(spark, rows), mixed(spark, rows[::-1], 7)
    assert {k: r.taken for k, r in first.items()} == {k: r.taken for k, r in again.items()}


def test_one_length_over_many_parts(spark, monkeypatch):
    rows = [(k, "same size text here", "a" if k % 2 else "b") for k in range(2000)]
    found = mixed(spark, rows)
    assert sum(r.taken for r in found.values() if r.source == "a") == pytest.approx(8000 * 5 / 7, abs=4)


def best_sum(lengths, counts, rest):
    sums = {0}
    for one, n in zip(lengths, counts, strict=True):
        sums = {s + k * one for s in sums for k in range(n + 1) if s + k * one <= rest}
    return max(sums)


@pytest.mark.parametrize("seed", range(20))
def test_the_knapsack_is_exact(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 60), 6, replace=False)) * rng.choice([1, 3])
    counts = rng.integers(0, 5, 6)
    for rest in rng.integers(0, int((lengths * counts).sum()) + 10, 6):
        taken = mixing.fill(lengths, counts, int(rest))
        assert (taken <= counts).all() and (taken >= 0).all()
        assert (lengths * taken).sum() == best_sum(lengths, counts, int(rest))


def test_large_rests_are_dealt_before_the_knapsack(monkeypatch):
    monkeypatch.setattr(mixing, "WINDOW", 500)
    rng = np.random.default_rng(5)
    lengths, counts = np.arange(1, 400), rng.integers(1, 50, 399)
    total = int((lengths * counts).sum())
    for rest in (0, 1, 777, total // 3, total - 1, total, total + 5):
        taken = mixing.fill(lengths, counts, rest)
        assert (taken <= counts).all() and (lengths * taken).sum() == min(rest, total)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, 1), (1, None, None, 2), (2, "", "a", 3)], "doc_id bigint, text string, source string, size int")
    assert {(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(docs).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    assert mixing.mix(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b c", "s")] * 4, "doc_id bigint, text string, source string")
    assert [r.taken for r in mixing.mix(twice).collect()] == [3] * 4


def test_all_weights_and_orders():
    for sizes in itertools.product([0, 1, 50], repeat=3):
        named = dict(zip("abc", sizes, strict=True))
        assert sum(shares(named).values()) == pytest.approx(sum(sizes))
