import base64
from pathlib import Path

import pytest
import tiktoken
from pyspark.sql import functions as F

from wordloom.operators import bpe
from wordloom.plans.queries import QUERIES

RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

TEXT = ["hello world", " a  b ", "", "don't é日本 12345", "hello hello", "x" * 300, "tab\there"]


def small_ranks():
    """All bytes and some merges."""
    merges = [b"he", b"ll", b"hell", b"hello", b"wo", b"rld", b"or", b"12", b"123", "é".encode()]
    table = {bytes([i]): i for i in range(256)}
    return table | {m: 256 + i for i, m in enumerate(merges)}


@pytest.fixture
def ranks_file(tmp_path):
    path = tmp_path / "ranks.txt"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in small_ranks().items()))
    return str(path)


def test_ids_equal_the_codec_word_by_word(spark, frame, ranks_file):
    encoder = bpe.Encoder(bpe.read_ranks(spark, ranks_file))
    codec = tiktoken.Encoding("own", pat_str=bpe.WORDS_100K, mergeable_ranks=small_ranks(), special_tokens={})
    rows = frame(list(enumerate(TEXT)), "i int, s string").select("i", "s", encoder.sentence_ids(F.col("s")).alias("ids"))
    for row in rows.collect():
        assert list(row.ids) == [t for w in row.s.split(" ") for t in codec.encode_ordinary(w)]
    words = frame([(w,) for t in TEXT for w in t.split(" ")], "w string")
    for row in words.select("w", encoder.word_ids(F.col("w")).alias("ids")).collect():
        assert list(row.ids) == codec.encode_ordinary(row.w)
        assert (row.ids == []) == (row.w == "")


def test_byte_table(spark, frame):
    encoder = bpe.Encoder(bpe.byte_ranks(spark))
    rows = frame([("é a",), (None,)], "s string").select("s", encoder.sentence_ids(F.col("s")).alias("ids"))
    assert {r.s: list(r.ids) for r in rows.collect()} == {"é a": [0xC3, 0xA9, 0x61], None: []}


def test_empty_sentences_give_no_row(spark, frame):
    encoder = bpe.Encoder(bpe.byte_ranks(spark))
    made = encoder.sentence_token_ids(frame([(1, ""), (2, "  "), (3, " a")], "doc_id long, sentence string")).collect()
    assert [(r.doc_id, list(r.token_ids)) for r in made] == [(3, [97])]


def test_decoding_replaces_broken_text(spark, frame, ranks_file):
    encoder = bpe.Encoder(bpe.read_ranks(spark, ranks_file))
    found = dict(map(tuple, encoder.decode(frame([(97,), (259,), (0xC3,), (97,), (9999,)], "token_id int")).collect()))
    assert found == {97: "a", 259: "hello", 0xC3: "�"}


def test_too_large_a_table(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_RANKS", 100)
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.byte_ranks(spark))


def test_words_of_the_corpus_equal_another_codec(spark):
    """The same vocabulary in another library, on every word of the smallest corpus."""
    tokenizers = pytest.importorskip("tokenizers")
    folder = Path(RANKS_FILE).parent
    if not Path(RANKS_FILE).exists():
        pytest.skip("no public rank table")
    other = tokenizers.Tokenizer.from_file(str(folder / "byte_bpe_50k.json"))
    other.encode_special_tokens = True
    encoder = bpe.Encoder(bpe.read_ranks(spark, RANKS_FILE), bpe.WORDS_50K)
    words = QUERIES["word_count"](spark, "/root/testdata/sf0.001").select("word")
    rows = words.withColumn("token_ids", encoder.word_ids(F.col("word"))).collect()
    expected = other.encode_batch([r.word for r in rows], add_special_tokens=False)
    assert len(rows) > 1000 and [list(r.token_ids) for r in rows] == [e.ids for e in expected]
