import pytest
from pyspark.sql import functions as F

from wordloom.functions import vectors as V
from wordloom.operators import samples


def model(tokens, size, stride, pad=0):
    """Windows by walking the tokens: stop at the first that reaches the end."""
    found, start = [], 0
    while start < len(tokens):
        piece = tokens[start : start + size]
        found.append([float(t) for t in piece] + [float(pad)] * (size - len(piece)))
        if start + size >= len(tokens):
            break
        start += stride
    return found


def cut(frame, tokens, size, stride, pad=0):
    rows = frame([(0, tokens)], "doc_id long, token_ids array<int>")
    made = samples.sliding_windows(rows, size, stride, pad).orderBy("sample_idx").collect()
    assert [r.sample_idx for r in made] == list(range(len(made)))
    return [list(r.vec) for r in made]


@pytest.mark.parametrize(
    "tokens, size, stride, expected",
    [
        ([1, 2, 3, 4, 5], 3, 1, [[1, 2, 3], [2, 3, 4], [3, 4, 5]]),
        ([1, 2], 3, 1, [[1, 2, 0]]),
        ([], 3, 1, []),
        ([1, 2, 3, 4, 5], 3, 2, [[1, 2, 3], [3, 4, 5]]),
        ([1, 2, 3, 4, 5], 10, 2, [[1, 2, 3, 4, 5, 0, 0, 0, 0, 0]]),
        ([1, 2, 3, 4, 5, 6], 2, 3, [[1, 2], [4, 5]]),
        ([1, 2, 3, 4], 2, 3, [[1, 2], [4, 0]]),
        ([1, 2, 3], 2, 4, [[1, 2]]),
    ],
)
def test_cases(frame, tokens, size, stride, expected):
    assert cut(frame, tokens, size, stride) == expected
    assert model(tokens, size, stride) == expected


def test_against_model_for_many_shapes(spark):
    rows = [(n, list(range(1, n + 1))) for n in range(0, 31)]
    ids = spark.createDataFrame(rows, "doc_id long, token_ids array<int>")
    for size in (1, 2, 3, 5, 10, 11):
        parts = []
        for stride in range(1, 12):
            made = samples.sliding_windows(ids, size, stride, 9).withColumn("stride", F.lit(stride))
            parts.append(made)
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        found = {}
        for r in union.collect():
            found[(r.stride, r.doc_id, r.sample_idx)] = list(r.vec)
        expected = {
            (stride, n, i): vec
            for stride in range(1, 12)
            for n, tokens in rows
            for i, vec in enumerate(model(tokens, size, stride, 9))
        }
        assert found == expected


def test_long_sentence(frame):
    tokens = list(range(1, 5001))
    assert cut(frame, tokens, 10, 3) == model(tokens, 10, 3)


def test_wrong_shape_and_large_id(frame):
    with pytest.raises(ValueError):
        V.windows(F.col("x"), 0, 1)
    with pytest.raises(ValueError):
        V.windows(F.col("x"), 1, 0)
    with pytest.raises(Exception, match="too large"):
        cut(frame, [1 << 25], 3, 1)
    rows = frame([(0, [(1 << 24) + 1])], "doc_id long, token_ids array<int>")
    assert samples.sliding_windows(rows, 2, 1, 0, "double").first().vec == [float((1 << 24) + 1), 0.0]


def test_pads_are_told_by_place(frame):
    rows = frame([(0, [0, 7])], "doc_id long, token_ids array<int>")
    made = samples.sliding_windows(rows, 4, 1, 0)
    assert made.select(samples.words_of(made)).first()[0] == ["0", "7"]
    assert made.select(samples.words_of(made, train_on_pad=True)).first()[0] == ["0", "7", "0", "0"]
