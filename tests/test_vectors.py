import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.functions import vectors as V
from wordloom.operators.word2vec import mean_vectors

SCHEMA = "a array<float>, b array<float>"


def value(frame, expression, a, b=None):
    return frame([(a, b)], SCHEMA).select(expression(F.col("a"), F.col("b"))).first()[0]


def test_text_form(frame):
    assert value(frame, lambda a, b: V.render(a), [1.0, 2.5, 3.7]) == "1.0;2.5;3.7"
    assert value(frame, lambda a, b: V.render(a), []) == ""
    assert value(frame, lambda a, b: V.render(a, " "), [1.0, 2.0]) == "1.0 2.0"
    back = value(frame, lambda a, b: V.parse(V.render(a)), [1.0, -2.5, 1e-4])
    assert back == pytest.approx([1.0, -2.5, 1e-4])
    assert value(frame, lambda a, b: V.parse(F.lit("1.5;x;-3")), []) == [1.5, None, -3.0]


@pytest.mark.parametrize("a, b, expected", [([1, 1], [2, 2], -1), ([2, 2], [1, 1], 1), ([1, 1], [1, 1], 0)])
def test_compare(frame, a, b, expected):
    floats = [float(x) for x in a], [float(x) for x in b]
    assert value(frame, lambda a, b: V.compare(a, b), *floats) == expected


def test_fold_is_a_product_of_squares(frame):
    assert value(frame, lambda a, b: V.fold(a), [2.0, 2.0]) == 16.0
    assert value(frame, lambda a, b: V.fold(a), [3.0]) == 3.0
    acc = np.float32(0.3)
    for x in (np.float32(-0.7), np.float32(1.9)):
        acc = np.float32(np.float64(acc) ** 2) * np.float32(np.float64(x) ** 2)
    assert value(frame, lambda a, b: V.fold(a), [0.3, -0.7, 1.9]) == acc


def test_divide(frame):
    assert value(frame, lambda a, b: V.divide(a, F.lit(2)), [2.0, 4.0, 6.0]) == [1.0, 2.0, 3.0]
    assert value(frame, lambda a, b: V.divide(a, F.lit(0)), [2.0]) == [None]


@pytest.mark.parametrize(
    "a, b, expected",
    [([1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [5.0, 7.0, 9.0]), (None, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0]), ([1.0, 2.0], [1.0, 2.0, 3.0], [1.0, 2.0])],
)
def test_add(frame, a, b, expected):
    assert value(frame, lambda a, b: V.add(a, b), a, b) == expected


def test_cut_copy_and_chunks(frame):
    vec = [1.0, 2.0, 3.0, 4.0, 5.0]
    assert value(frame, lambda a, b: V.cut(a, 1, 3), vec) == [2.0, 3.0, 4.0]
    assert value(frame, lambda a, b: V.copy_range(a, 1, 3), vec) == [0.0, 2.0, 3.0, 4.0, 0.0]
    assert value(frame, lambda a, b: V.copy_range(a), vec) == vec
    assert value(frame, lambda a, b: V.chunks(a, 2), vec) == [[1.0, 2.0], [3.0, 4.0], [5.0]]


def test_mean(frame):
    rows = frame([(1, [2.0, 4.0, 6.0]), (1, [4.0, 8.0, 12.0]), (2, [1.0, -1.0, 0.0])], "k int, v array<float>")
    found = {r.k: list(r.mean) for r in mean_vectors(rows, "k", "v").collect()}
    assert found == {1: [3.0, 6.0, 9.0], 2: [1.0, -1.0, 0.0]}


def test_mean_with_a_hot_key_and_unequal_lengths(frame):
    rows = [(1, [float(i), 1.0]) for i in range(300)] + [(k, [float(k), 2.0]) for k in range(2, 50)]
    found = {r.k: list(r.mean) for r in mean_vectors(frame(rows, "k int, v array<float>"), "k", "v").collect()}
    assert math.isclose(found[1][0], 149.5) and found[7] == [7.0, 2.0]
    with pytest.raises(Exception):
        mean_vectors(frame([(1, [1.0]), (1, [1.0, 2.0])], "k int, v array<float>").coalesce(1), "k", "v").collect()
