from collections import Counter

from pyspark.sql import functions as F

from wordloom.operators import counts, dictionary, lines
from wordloom.operators.ranking import with_position


def test_word_count_keeps_case_punctuation_and_the_empty_word(frame):
    words = ["a", "A", "a,", "", "a", "b"]
    found = {r.word: r.n for r in counts.word_count(frame([(w,) for w in words], "word string")).collect()}
    assert found == Counter(words)
    limited = counts.word_count(frame([(w,) for w in words], "word string"), 2).collect()
    assert [(r.word, r.n) for r in limited] == [("a", 2)]


def test_documented_merge(frame):
    words = frame([("hello",)] * 3, "word string")
    assert [(r.word, r.n) for r in counts.word_count(words).collect()] == [("hello", 3)]


def test_vocabulary_sizes(frame):
    table = frame([("a", 3, "1"), ("b", 2, "12;7"), ("", 1, "")], "word string, n long, ids string")
    assert counts.vocab_size(table).first()[0] == 3
    assert counts.vocab_size_by_id_text(table, F.col("ids")).first()[0] == 1 + 4 + 1
    assert counts.vocab_size_by_id_text(table.where("false"), F.col("ids")).first()[0] == 0


def test_positions_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 13).select(((F.col("id") * 7919) % 5000).alias("v"))
    found = with_position(rows, [F.desc("v")], "p").collect()
    assert sorted((r.p, r.v) for r in found) == [(i + 1, 4999 - i) for i in range(5000)]
    assert with_position(rows.where("v < 0"), [F.asc("v")], "p").isEmpty()
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        found = with_position(rows, [F.asc("v")], "p", start=0).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert all(r.p == r.v for r in found) and len(found) == 5000


def skewed_words():
    return ["the"] * 400 + ["of"] * 90 + [f"w{i % 37}" for i in range(300)] + [f"rare{i}" for i in range(120)] + [""] * 5


def expected_ids(words):
    count = Counter(w for w in words if w)
    return {w: i + 1 for i, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0].encode())))}


def test_dictionary(frame):
    words = skewed_words()
    made = dictionary.build_dictionary(frame([(w,) for w in words], "word string"))
    assert {r.word: r.token_id for r in made.collect()} == expected_ids(words)
    with_blank = {r.word: (r.n, r.token_id) for r in dictionary.count_with_ids(frame([(w,) for w in words], "word string")).collect()}
    assert with_blank[""] == (5, None) and with_blank["the"] == (400, 1)


def test_hot_and_cold_words_give_the_same_ids(frame):
    words = skewed_words()
    ids = expected_ids(words)
    tokens = frame([(i // 10, i % 10, w) for i, w in enumerate(words) if w], "doc_id long, tok_idx int, word string")
    known = dictionary.build_dictionary(tokens)
    expected = {}
    for i, w in enumerate(words):
        if w:
            expected.setdefault(i // 10, []).append(ids[w])
    for max_bytes in (dictionary.HOT_BYTES, 1000, 0):
        made = dictionary.sentence_token_ids(tokens, known, max_bytes)
        assert {r.doc_id: list(r.token_ids) for r in made.collect()} == expected
    assert dictionary.hot_limit(known) is None
    limit = dictionary.hot_limit(known, 1000)
    assert 2 <= limit < len(ids)
    size = known.where(F.col("token_id") < limit).agg(F.sum(F.octet_length("word") + dictionary.ROW_BYTES)).first()[0]
    assert size <= 1000


def test_unknown_words_and_decoding(frame):
    known = dictionary.build_dictionary(frame([("a",), ("a",), ("b",)], "word string"))
    tokens = frame([(1, 0, "a"), (1, 1, "zzz"), (1, 2, "b"), (2, 0, "zzz")], "doc_id long, tok_idx int, word string")
    made = dictionary.sentence_token_ids(tokens, known).collect()
    assert [(r.doc_id, list(r.token_ids)) for r in made] == [(1, [1, 2])]
    ids = frame([(2,), (1,), (2,), (99,)], "token_id int")
    assert sorted(map(tuple, dictionary.decode(ids, known).collect())) == [(1, "a"), (2, "b")]


def test_large_input_is_shuffled_once(spark):
    tokens = spark.range(0, 1000, 1, 64).select(
        F.xxhash64("id").alias("doc_id"), F.lit(0).alias("tok_idx"), F.concat(F.lit("w"), F.col("id") % 7).alias("word")
    )
    known = dictionary.build_dictionary(tokens)
    plan = dictionary.sentence_token_ids(tokens, known)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    cold = dictionary.sentence_token_ids(tokens, known, 300)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in cold and "partial_collect_list" in cold


def test_sentences_give_the_ids_of_their_tokens(frame):
    """Before, every token was joined and gathered again; now only sentences with words that are not broadcast are."""
    said = ["b a  a", " a b ", "", "   ", "a", "c a é rare", "\ta", "x y z a", None]
    rows = [(k % 7 if k < 60 else None, k // 7, s) for k, s in enumerate(said * 8)]
    sentences = frame(rows, "doc_id bigint, line_no int, sentence string")
    tokens = lines.to_tokens(sentences)
    known = dictionary.build_dictionary(tokens.where("word <> 'z'"))
    ids = lambda df: sorted(((r.doc_id, r.line_no, r.token_ids) for r in df.collect()), key=str)
    for size in (64 << 20, 150, 1):
        assert ids(dictionary.sentence_token_ids(sentences, known, size)) == ids(dictionary.sentence_token_ids(tokens, known, size))
    single = sentences.dropDuplicates(["doc_id", "line_no"]).localCheckpoint()
    for size in (64 << 20, 150, 1):
        made = dictionary.sentence_token_ids(single, known, size, once=True)
        assert ids(made) == ids(dictionary.sentence_token_ids(lines.to_tokens(single), known, size))
    plan = dictionary.sentence_token_ids(single, known, once=True)._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_rows_of_one_id_are_one_sentence_as_before(spark, tmp_path):
    from wordloom.plans.queries import QUERIES

    docs = [(1, "a b c"), (1, "d e f g"), (2, "a b"), (None, "x"), (None, "y z")]
    for name, rows in (("twice", docs), ("once", docs[1:3])):
        spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        made = {r.doc_id: len(r.ids_str.split(";")) for r in QUERIES["sentence_token_ids"](spark, str(tmp_path / name)).collect()}
        assert made == ({1: 7, 2: 2, None: 3} if name == "twice" else {1: 4, 2: 2})
