import pytest
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.operators import lines


def one(frame, value, expression):
    return frame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("", [""]), ("   ", []), (" a  b ", ["", "a", "", "b"]), ("a", ["a"]), ("a,b c", ["a,b", "c"]), ("a\tb", ["a\tb"])],
)
def test_words(frame, text, expected):
    assert one(frame, text, T.split_words) == expected


@pytest.mark.parametrize(
    "text, pattern, expected",
    [
        ("hello world! foo", T.SENTENCE_BREAK, ["hello worl", " foo"]),
        ("a! b", T.SENTENCE_BREAK, ["", " b"]),
        ("Hi. You? Ok", T.SENTENCE_BREAK, ["Hi. You? Ok"]),
        ("Hi. You? Ok", T.PUNCTUATION_BREAK, ["Hi", " You", " Ok"]),
        ("end!", T.SENTENCE_BREAK, ["en"]),
        ("!", T.SENTENCE_BREAK, []),
        ("a!b!!!", T.SENTENCE_BREAK, []),
        ("xa!y", T.SENTENCE_BREAK, ["x", "y"]),
        ("", T.SENTENCE_BREAK, [""]),
        ("one. two...", T.PUNCTUATION_BREAK, ["one", " two"]),
    ],
)
def test_sentences(frame, text, pattern, expected):
    assert one(frame, text, lambda x: T.split_pattern(x, pattern)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a\nb", ["a", "b"]),
        ("a\nb\n", ["a", "b"]),
        ("a\r\nb\rc\r\n", ["a", "b", "c"]),
        ("a\n\n\nb", ["a", "", "", "b"]),
        ("\n", [""]),
        ("\n\n", ["", ""]),
        ("", None),
        (None, None),
        ("no end ", ["no end "]),
    ],
)
def test_lines(frame, text, expected):
    assert one(frame, text, T.split_lines) == expected


def test_positions_and_empty_words(frame):
    docs = frame([(1, "a b\n\nc! d"), (2, ""), (3, None)], "doc_id long, text string")
    made = lines.to_lines(docs)
    assert sorted(map(tuple, made.collect())) == [(1, 0, "a b"), (1, 1, ""), (1, 2, "c! d")]
    words = sorted((r.line_no, r.word_idx, r.word) for r in lines.to_words(made).collect())
    assert words == [(0, 0, "a"), (0, 1, "b"), (1, 0, ""), (2, 0, "c!"), (2, 1, "d")]
    assert lines.to_words(made, drop_empty=True).where("word = ''").isEmpty()
    sentences = lines.to_sentences(made)
    assert sorted((r.line_no, r.sentence_idx, r.sentence) for r in sentences.collect()) == [
        (0, 0, "a b"), (1, 0, ""), (2, 0, ""), (2, 1, " d"),
    ]
    assert sorted((r.line_no, r.sentence_idx) for r in lines.without_tokens(sentences).collect()) == [(1, 0), (2, 0)]
    extent = {r.line_no: (r.n_sentences, r.max_idx) for r in lines.sentence_extent(made).collect()}
    assert extent == {0: (1, 0), 1: (1, 0), 2: (2, 1)}


def test_documented_split(frame):
    made = lines.to_sentences(frame([(0, "hello world. This is a test.")], "doc_id long, line string"), T.PUNCTUATION_BREAK)
    words = lines.to_tokens(made).orderBy("sentence_idx", "tok_idx").collect()
    assert [r.word for r in words if r.sentence_idx == 0] == ["hello", "world"]
    assert [r.word for r in words if r.sentence_idx == 1] == ["This", "is", "a", "test"]
