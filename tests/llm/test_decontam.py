import random
import re

import pytest

from wordloom.llm import decontam


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def runs(w, width):
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def expected(docs, items, width=5, percent=80):
    out = set()
    for item_id, item in items:
        w = words(item)
        if not w or item_id is None:
            continue
        own = runs(w, min(width, len(w)))
        for doc_id, text in docs:
            shared = len(own & runs(words(text), min(width, len(w))))
            if doc_id is not None and shared and 100 * shared >= percent * len(own):
                out.add((doc_id, item_id, shared, len(own)))
    return out


def got(spark, docs, items):
    made = decontam.contained_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    rows = made.collect()
    assert all(abs(r.containment - r.n_shared / r.n_item) < 1e-12 for r in rows)
    assert len(rows) == len(set(rows))
    return {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in rows}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    items = [(k, " ".join(word() for _ in range(rng.randint(6, 60)))) for k in range(30)]
    docs = []
    for k in range(120):
        text = [word() for _ in range(rng.choice([0, 10, 300, 4000 if k % 40 == 0 else 50]))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = word()
            at = rng.randint(0, len(text))
            text[at:at] = part[rng.randint(0, 3) :]
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(text).replace("a", rng.choice("aA"))))
    return docs, items


def test_equals_brute_force(spark, corpus):
    want = expected(*corpus)
    assert len(want) > 20
    assert got(spark, *corpus) == want


def test_without_broadcasts(spark, corpus, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert got(spark, *corpus) == expected(*corpus)


def test_odd_texts_and_short_items(spark):
    docs = [(1, None), (2, ""), (3, "one"), (4, "one two three"), (5, "x one two three four five six y"), (6, "q " * 9000 + "one two"), (None, "one"), (7, "one two"), (7, "one two")]
    items = [(1, "one"), (2, "One two"), (3, "one two three four five six"), (4, None), (5, "  "), (None, "one"), (6, "q q q q q q q q"), (2, "One two"), (8, "one two")]
    assert got(spark, docs, items) == expected(docs, items)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id bigint, text string")
    assert decontam.contained_items(empty, items).count() == 0
    assert decontam.contained_items(docs, items.limit(0)).count() == 0


def test_clashing_columns_and_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 1)], "doc_id bigint, text string, item_id string, width int")
    items = spark.createDataFrame([(1, "a b c d e f", "x", 1)], "item_id bigint, text string, doc_id string, need int")
    made = decontam.contained_items(docs, items)
    assert [(r.doc_id, r.item_id, r.n_shared) for r in made.collect()] == [(1, 1, 2)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
