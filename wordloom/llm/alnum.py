"""Texts as lower-cased words of digits, letters and other characters beyond ASCII.

A word is a run of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. In
UTF-8 those are the bytes 0-9, a-z and all from 0x80 on, so words can be cut on bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from wordloom.llm.words import text_bytes

#: The same words, lower-cased before, for Spark's regular expressions.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPACE = 32
#: What each byte becomes; all bytes outside words become a space.
LOWER = np.full(256, SPACE, np.uint8)
LOWER[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
LOWER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LOWER[0x80:] = np.arange(0x80, 0x100)


class Words(NamedTuple):
    """All words of a text column, in order, each followed by one space."""

    data: np.ndarray
    #: First byte and end of every word in ``data``.
    starts: np.ndarray
    ends: np.ndarray
    #: Words of every row.
    per_row: np.ndarray


def normal_form(column: pa.Array | pa.ChunkedArray) -> Words:
    """The words of a text column with single spaces; null counts as empty, rows never share a word."""
    raw, bounds = text_bytes(column)
    lower = LOWER[raw]
    inside = lower != SPACE
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(raw)]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    per_row = np.diff(np.searchsorted(starts, bounds))
    packed = lower[inside]
    # where each word begins among the bytes of all words, and where once a space follows each
    begin = np.cumsum(inside, dtype=np.int64)[starts] - 1 if len(starts) else starts
    length = np.diff(np.append(begin, len(packed)))
    at = begin + np.arange(len(begin))
    data = np.full(len(packed) + len(begin), SPACE, np.uint8)
    letters = np.ones(len(data), bool)
    letters[at + length] = False
    data[letters] = packed
    return Words(data, at, at + length, per_row)
