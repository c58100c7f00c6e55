"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much goes.

Everything is a column expression, so the whole step is one map over the documents without Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import GAP, WORD

# Fixed values of the result: characters that count as symbols, and the limits of the base rules.
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Least share of the characters in a document's lines that must be left, in percent.
MIN_LEFT_PERCENT = 60
#: A line with more symbols than one in so many characters is layout, not prose.
SYMBOL_EVERY = 14
#: The end of a sentence anywhere in a line: a long line that was cut off is still prose. Marks that end sentences in
#: other scripts need no space after them; Thai and Lao have none, there a long run of letters is prose.
ENDS = (
    r"""[.!?…:;"”’»)\]](?:[\x20\x09-\x0D]|$)|[\u0589\u061B\u061D-\u061F\u06D4\u0700-\u0702\u07F9\u0837\u0839\u083D\u083E\u0964\u0965"""
    r"""\u0F0D-\u0F12\u104A\u104B\u1362\u1367\u1368\u166E\u1735\u1736\u17D4\u17D5\u1803\u1809\u1944\u1945\u1AA8-\u1AAB\u1B5A\u1B5B\u1B5E\u1B5F"""
    r"""\u1C3B\u1C3C\u1C7E\u1C7F\u203C\u203D\u2047-\u2049\u2CF9-\u2CFB\u2E2E\u2E3C\u3002\uA4FF\uA60E\uA60F\uA6F3\uA6F7\uA876\uA877"""
    r"""\uA8CE\uA8CF\uA92F\uA9C8\uA9C9\uAA5D-\uAA5F\uAAF0\uAAF1\uABEB\uFE52\uFE56\uFE57\uFF01\uFF0E\uFF1A\uFF1B\uFF1F\uFF61]|[\p{IsThai}\p{IsLao}]{20}"""
)
SHOUTS = r"!![^!]+!!"
NAVIGATION = r"[|»›·>][^|»›·>]+[|»›·>]"
#: What parts a menu; a middle dot between letters is part of a word, and quotation marks in pairs are taken off first.
SEPARATOR = r"[|»›>]|(?<![\p{L}\p{N}])·|·(?![\p{L}\p{N}])"
QUOTED = (r"«([^«»]*)»", r"»([^«»]*)«", r"‹([^‹›]*)›", r"›([^‹›]*)‹")
#: Most characters of a menu's segment.
SHORT_SEGMENT = 30
#: A line of at most so many characters goes for one boilerplate phrase; a longer one is prose unless half of it is phrases.
SHORT_LINE = 100
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|accept (?:all )?cookies|use[sd]? cookies|cookie policy|privacy policy|terms of (?:use|service)|"
    r"subscribe to|sign up for|log in to|enable javascript|javascript is|click here|read more|share this|powered by|"
    r"skip to (?:main )?content|back to top|lorem ipsum)\b"
)


def n_symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))


def _chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def _is_menu(line: Column) -> Column:
    """Whether a line of two separators or more is made of short segments for the most part."""
    plain = line
    for quoted in QUOTED:
        plain = F.regexp_replace(plain, quoted, "$1")
    segments = F.split(plain, SEPARATOR, -1)
    short = F.filter(segments, lambda s: s.rlike(WORD) & (F.length(F.trim(s)) <= SHORT_SEGMENT))
    return (F.size(segments) > 2) & (F.size(short) > 1) & (2 * _chars(short) >= _chars(segments))


def _is_boilerplate(line: Column) -> Column:
    rest = F.length(F.regexp_replace(line, BOILERPLATE, ""))
    return line.rlike(BOILERPLATE) & ((F.length(line) <= SHORT_LINE) | (2 * rest <= F.length(line)))


def line_fails(line: Column) -> Column:
    """Whether a line fails a rule: punctuation, navigation or boilerplate. Blank lines pass."""
    symbols = n_symbols(line)
    punctuation = (symbols * SYMBOL_EVERY > F.length(line)) | ~line.rlike(ENDS) | line.rlike(SHOUTS)
    navigation = line.rlike(NAVIGATION) & _is_menu(line)
    return line.rlike(WORD) & (punctuation | navigation | _is_boilerplate(line))


def _repeated(hashes: str) -> list[tuple[str, str]]:
    """Columns that lead from window hashes to the number of words inside repeated windows.

    Windows are sorted with their places only where a text has a repeated one at all.
    """
    return [
        ("ranked", f"CASE WHEN size(array_distinct({hashes})) < size({hashes}) THEN sort_array(transform({hashes}, (x, i) -> struct(x AS h, i AS i))) END"),
        ("again", "filter(ranked, (e, k) -> (k > 0 AND get(ranked, k - 1).h = e.h) OR get(ranked, k + 1).h <=> e.h)"),
        (
            "n_repeat_words",
            "coalesce(aggregate(sort_array(transform(again, e -> e.i)), struct(-3 AS last, 0L AS n), "
            "(a, i) -> struct(i AS last, a.n + least(3, i - a.last) AS n), a -> a.n), 0L)",
        ),
    ]


def quality_rules(docs: DataFrame, min_left_percent: int = MIN_LEFT_PERCENT) -> DataFrame:
    """Counts, verdict and cleaned text per row of ``docs`` (doc_id, text, any other columns).

    Gives doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    clean_text (the text without its failing lines; null for a null text). A null text counts as
    empty: no words, base_failed. A text of blank lines loses nothing by its lines but fails the base
    rules. Each row is judged alone, so ties and repeated rows give equal rows; an empty table none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("t"), F.col("text").isNull().alias("none"))
    rows = rows.select("doc_id", "t", "none", F.split("t", "\n", -1).alias("lines"), F.filter(F.split("t", GAP, -1), lambda w: w != "").alias("words"))
    rows = rows.withColumn("hashes", F.expr("CASE WHEN size(words) > 2 THEN transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))) ELSE array() END"))
    for name, sql in _repeated("hashes"):
        rows = rows.withColumn(name, F.expr(sql))
    worded = F.filter("lines", lambda x: x.rlike(WORD))
    rows = rows.withColumn("worded", worded).withColumn("left", F.filter("lines", lambda x: ~line_fails(x)))
    n_words = F.size("words").cast("long")
    failed = (n_words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n_words)
    judged = F.struct(
        n_words.alias("n_words"),
        _chars("words").alias("word_chars"),
        n_symbols(F.col("t")).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * _chars("left") >= min_left_percent * _chars("lines"))).alias("kept"),
        F.when(~F.col("none"), F.array_join("left", "\n")).alias("clean_text"),
    )
    # a generator of one row: a caller's filter is not pushed below it, where it would put the arrays' expressions
    # into the lambdas that read them, once per word
    return rows.select("doc_id", F.inline(F.array(judged)))
