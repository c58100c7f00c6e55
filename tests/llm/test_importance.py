import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordloom.llm import importance
from wordloom.llm.alnum import normal_form
from wordloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text):
    ws = words(text)
    return [" ".join(ws[i : i + n]).encode() for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute_force(docs, target):
    s = Counter(zlib.crc32(f) % 10000 for _, text in docs for f in features(text))
    t = Counter(zlib.crc32(f) % 10000 for text in target for f in features(text))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f) % 10000] for f in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(made):
    return sorted((tuple(r[c] for c in COLUMNS) for r in made.collect()), key=str)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é中 \n-_", max_size=40)), max_size=8))
def test_every_run_has_its_crc(texts):
    got = Counter()
    for row, crc in importance.feature_crcs(normal_form(pa.array(texts, pa.string()))):
        got.update(zip(row.tolist(), crc.tolist()))
    assert got == Counter((k, zlib.crc32(f)) for k, text in enumerate(texts) for f in features(text))


def test_long_words_and_texts_cross_lanes_and_blocks(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 7)
    texts = ["x" * 100_000 + " y " + "é" * 70_000 + " z", "end", "end", " ".join(f"w{k % 13}" for k in range(3000))]
    got = Counter()
    for row, crc in importance.feature_crcs(normal_form(pa.array(texts))):
        got.update(zip(row.tolist(), crc.tolist()))
    assert got == Counter((k, zlib.crc32(f)) for k, text in enumerate(texts) for f in features(text))


def test_shift_equals_zero_bytes():
    register = np.array([1, 0xFFFFFFFF, 0x12345678], np.uint32)
    for n in (0, 1, 255, 256, 70_000):
        slow = register
        for _ in range(n):
            slow = importance._step(slow)
        assert (importance.shift(register, np.full(3, n)) == slow).all()


def corpus():
    rng = np.random.default_rng(5)
    docs = [(k, " ".join(rng.choice(["alpha", "Beta", "ü", "42", "the"], rng.integers(0, 60)))) for k in range(300)]
    return [*docs, (300, None), (301, ""), (302, "word " * 5000), (None, "alpha " * 30), (7, docs[7][1]), (7, docs[7][1])]


def test_equals_brute_force(spark):
    docs, target = corpus(), ["alpha beta 42", None, "", "the ü"]
    frame = spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id bigint, text string, rank string, bucket int").repartition(3)
    aims = spark.createDataFrame([(1, t) for t in target], "doc_id bigint, text string")
    assert found(importance.resample(frame, aims)) == brute_force(docs, target)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(k, "same words " * 15) for k in range(200)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    made = importance.resample(frame, frame)
    assert found(made) == brute_force(docs, [t for _, t in docs])


@pytest.mark.parametrize("docs, target", [([], []), ([], ["a b"]), ([(1, "a b " * 20)], [])])
def test_empty_tables(spark, docs, target):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(importance.resample(frame, aims)) == brute_force(docs, target)


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert found(QUERIES["op12_importance"](spark, sf)) == brute_force(docs, target)
