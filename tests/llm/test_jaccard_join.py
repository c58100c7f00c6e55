import collections
import random
import re

import numpy as np
import pytest

from wordloom.llm import jaccard_join
from wordloom.llm.components import components


def expected(rows, width=4, percent=85):
    sets = {}
    for k, (_, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[k] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = collections.defaultdict(lambda: 1 << 60)
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least[root(k)], doc_id)
    return sorted((rows[k][0], len(sets[k]), least[root(k)]) for k in sets)


def got(frame, rows, **more):
    made = jaccard_join.jaccard_components(frame(rows, "doc_id bigint, text string"), **more)
    return sorted(tuple(r) for r in made.collect())


def near_copies(seed, groups, size, words=60, foreign=40):
    """Groups of texts with a few words changed each, and a passage that texts share besides."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage, rows = [word() for _ in range(25)], []
    for _ in range(groups):
        origin = [word() for _ in range(rng.randint(words // 2, words))]
        for _ in range(size):
            copy = list(origin)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join([*(word() for _ in range(rng.randint(0, 30))), *passage, *(word() for _ in range(rng.randint(0, 30)))]) for _ in range(foreign)]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(frame, seed):
    rows = near_copies(seed, groups=3, size=25)
    assert got(frame, rows) == expected(rows)


def test_other_widths_and_thresholds(frame):
    rows = near_copies(3, groups=3, size=20)
    assert got(frame, rows, width=5, percent=80) == expected(rows, 5, 80)


def test_hot_columns_only_change_the_order(frame, monkeypatch):
    rows = near_copies(4, groups=2, size=30, foreign=30)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 4)
    assert got(frame, rows) == expected(rows)


def test_odd_texts(frame):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "one two three"), (9, "a b c d"), (8, "a b c d e"), (10, "x " * 9000), (11, "x " * 4)]
    assert got(frame, rows) == expected(rows)


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(5, "a b c d e f", 1, "n"), (5, "a b c d e f", 2, "n"), (3, "a b c d e f", 3, "n"), (7, "q r s t", 4, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint, shingles string")
    made = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert made == [(3, 3, 3), (5, 3, 3), (5, 3, 3), (7, 1, 7)]


def test_a_null_id_names_nothing(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "lone text of some words")], "doc_id bigint, text string")
    made = sorted(((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()), key=str)
    assert made == [(4, 4), (None, 4), (None, None)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.jaccard_components(docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(500, k) for k in range(501, 540)]
    links = spark.createDataFrame([*path, *star, (7, 7)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(500, 540), 500)}


def all_links(rows, width=4, percent=85):
    """Links of distinct sets by their smallest ids with the overlap, and per row its class and number of links."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    name = {s: min(rows[k][0] for k in range(len(rows)) if sets[k] == s) for s in set(sets) if s}
    agree = lambda s, t: s and t and 100 * len(s & t) >= percent * len(s | t)
    links = sorted((name[s], name[t], len(s & t)) for s in name for t in name if name[s] < name[t] and agree(s, t))
    members = sorted((rows[k][0], len(s), name.get(s, -1), sum(bool(agree(s, t)) for j, t in enumerate(sets) if j != k)) for k, s in enumerate(sets))
    return members, links


@pytest.mark.parametrize("split, step, cell", [(256, 1 << 20, 1 << 21), (2, 50, 1 << 11)])
def test_links_equal_all_pairs(frame, monkeypatch, split, step, cell):
    monkeypatch.setattr(jaccard_join, "SPLIT", split)
    monkeypatch.setattr(jaccard_join, "STEP", step)
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    rows = near_copies(6, groups=3, size=20, foreign=20)
    rows += [(20_000 + k, text) for k, (_, text) in enumerate(rows[:7])] + [(30_000, None), (30_001, "")]
    members, links = jaccard_join.jaccard_links(frame(rows, "doc_id bigint, text string"))
    wanted = all_links(rows)
    assert wanted[1]
    assert sorted(tuple(r) for r in links.collect()) == wanted[1]
    assert sorted((r.doc_id, r.n_shingles, -1 if r.class_id is None else r.class_id, r.n_links) for r in members.collect()) == wanted[0]
    assert got(frame, rows) == expected(rows)


def test_every_row_meets_the_first_of_its_column(frame):
    rows = [(1, 100, 7, 0, 0), (2, 100, 7, 1, 1), (3, 100, 7, 1, 2), (4, 100, 7, 0, 1), (5, 100, 8, 0, 0)]
    star = jaccard_join._star(frame(rows, "id bigint, n bigint, shingle bigint, part bigint, place bigint"), 85)
    assert sorted((r.a, r.b) for r in star.collect()) == [(2, 1), (3, 1), (3, 2), (4, 1)]


def test_copies_of_one_text_leave_few_pairs_after_the_star(frame, monkeypatch):
    """Two copies differ by more than the threshold, each of them and the text by less."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    origin, rows = [word() for _ in range(150)], []
    for k in range(300):
        copy = list(origin)
        for at in rng.sample(range(2, 150, 5), 2):
            copy[at] = word()
        rows.append((k + 1, " ".join(copy)))
    rows.append((0, " ".join(origin)))
    seen, rest = [], jaccard_join._rest
    monkeypatch.setattr(jaccard_join, "_rest", lambda places, percent: (seen.append(rest(places, percent).count()), rest(places, percent))[1])
    assert got(frame, rows) == expected(rows)
    assert seen[0] <= len(rows)


def test_ids_that_unlike_texts_share(frame):
    rows = near_copies(8, groups=2, size=6, foreign=0)
    rows = [(k // 2, text) for k, (_, text) in enumerate(rows)]
    sets = expected(rows)
    made = got(frame, rows)
    assert [r[:2] for r in made] == [r[:2] for r in sets]
    assert {r[2] for r in made} <= {r[0] for r in rows}


def test_names_keep_whole_hashes():
    rng = np.random.default_rng(3)
    hashes = np.sort(rng.integers(0, 1 << 64, 20_000, np.uint64))
    for blocks in (256, 257, 1000):
        block = jaccard_join.block_of(hashes, blocks)
        low = jaccard_join.unpack(jaccard_join.pack(hashes))
        back = np.concatenate([jaccard_join.column_names(low[block == k], k, blocks) for k in range(blocks)])
        assert (back == hashes).all()


def test_hot_columns_of_long_texts_are_seen(frame):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=8))
    rows = [(k, " ".join([word() for _ in range(4000)] + (["one", "two", "three", "four"] if k % 30 == 0 else []))) for k in range(240)]
    found = jaccard_join.describe(frame(rows, "doc_id bigint, text string").coalesce(1)).where("hot is not null").collect()
    assert sum(h.n for r in found for h in r.hot) >= 4
