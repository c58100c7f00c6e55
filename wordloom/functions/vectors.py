"""Vectors as ARRAY<FLOAT>: text form, arithmetic, comparison, windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def render(vector: Column, separator: str = ";") -> Column:
    """Text form of a vector; an empty vector is the empty string."""
    return F.array_join(vector.cast("array<string>"), separator)


def parse(text: Column, separator: str = ";") -> Column:
    """Vector from its text form; parts that are no number become NULL."""
    return F.transform(F.split(text, separator), lambda part: part.try_cast("float"))


def add(left: Column, right: Column) -> Column:
    """Element-wise sum. A missing left side gives the right one, unequal lengths give the left one."""
    return (
        F.when(left.isNull(), right)
        .when(F.size(left) == F.size(right), F.zip_with(left, right, lambda a, b: a + b))
        .otherwise(left)
    )


def divide(vector: Column, divisor: Column) -> Column:
    """Every element over a whole number, in single precision; NULL elements when it is zero."""
    by = divisor.cast("float")
    return F.transform(vector, lambda x: F.try_divide(x, by).cast("float"))


def fold(vector: Column) -> Column:
    """Left fold of a^2 * b^2 in single precision. One element is returned as it is."""

    def square(x: Column) -> Column:
        return F.pow(x, F.lit(2.0)).cast("float")

    rest = F.slice(vector, F.lit(2), F.greatest(F.size(vector) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(vector, F.lit(0)), lambda acc, x: square(acc) * square(x))


def compare(left: Column, right: Column) -> Column:
    """-1, 0 or 1 by the folds of two vectors."""
    a, b = fold(left), fold(right)
    return F.when(a == b, 0).when(a < b, -1).otherwise(1)


def cut(vector: Column, start: int, length: int) -> Column:
    """The elements from ``start`` (zero-based), ``length`` of them at most."""
    return F.slice(vector, F.lit(start + 1), F.lit(length))


def copy_range(vector: Column, start: int = 0, length: int | None = None) -> Column:
    """A vector of the same size with ``length`` elements from ``start`` copied and zero elsewhere."""
    if length is None:
        return vector
    return F.transform(
        vector, lambda x, i: F.when((i >= start) & (i < start + length), x).otherwise(F.lit(0.0).cast("float"))
    )


def chunks(vector: Column, length: int) -> Column:
    """Consecutive pieces of ``length`` elements; the last may be shorter."""
    last = F.size(vector) - 1
    starts = F.sequence(F.lit(0), last, F.lit(length))
    return F.when(last >= 0, F.transform(starts, lambda s: F.slice(vector, s + 1, F.lit(length))))


def windows(items: Column, size: int, stride: int) -> Column:
    """Windows of up to ``size`` elements, one every ``stride``, to the first that reaches the end.

    NULL for an empty array, so that exploding it gives no row. One pass over the windows keeps
    the memory at size/stride times the array, whatever the length of the sentence.
    """
    if size < 1 or stride < 1:
        raise ValueError("window size and stride must be positive")
    n = F.size(items)
    reaching_end = F.ceil(F.greatest(n - size, F.lit(0)) / stride) + 1
    starting_inside = F.ceil(n / stride)
    last_start = (F.least(reaching_end, starting_inside).cast("int") - 1) * stride
    starts = F.sequence(F.lit(0), last_start, F.lit(stride))
    return F.when(n > 0, F.transform(starts, lambda s: F.slice(items, s + 1, F.lit(size))))


def pad_right(vector: Column, size: int, pad: Column) -> Column:
    """Append ``pad`` up to ``size`` elements."""
    return F.concat(vector, F.array_repeat(pad, F.lit(size) - F.size(vector)))
