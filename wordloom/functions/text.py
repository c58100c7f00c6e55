"""Splitting text into lines, words and sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line terminators of a text input, and the two sentence patterns.
# SENTENCE_BREAK takes the character before an exclamation mark with it and ignores other marks;
# PUNCTUATION_BREAK ends a sentence at each of the three marks.
LINE_BREAK = r"\r\n|[\r\n]"
SENTENCE_BREAK = ".?!"
PUNCTUATION_BREAK = "[.?!]"


def split_lines(text: Column) -> Column:
    """Lines of a text: a last terminator opens no further line, and empty text has no lines."""
    length = F.length(text)
    body = (
        F.when(text.endswith("\r\n"), F.substring(text, F.lit(1), length - 2))
        .when(text.endswith("\n") | text.endswith("\r"), F.substring(text, F.lit(1), length - 1))
        .otherwise(text)
    )
    return F.when(text != "", F.split(body, LINE_BREAK))


def split_words(text: Column) -> Column:
    """Words between single spaces.

    Leading and inner empty words stay, trailing ones go; empty text is one empty word and
    text of spaces only has none.
    """
    trimmed = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def split_pattern(text: Column, pattern: str) -> Column:
    """Split by a regular expression and drop trailing empty parts; no match gives the text itself."""
    parts = F.split(text, pattern)
    filled = F.transform(parts, lambda part, i: F.when(part != "", i + 1))
    return F.when(
        (F.size(parts) == 1) | (F.element_at(parts, -1) != ""), parts
    ).otherwise(F.slice(parts, F.lit(1), F.coalesce(F.array_max(filled), F.lit(0))))
