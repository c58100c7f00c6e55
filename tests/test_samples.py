from collections import Counter

import pytest

from wordloom.operators import rejects, samples, sharding
from wordloom.functions import vectors as V
from pyspark.sql import functions as F

KEYS = "doc_id long, line_no int, sentence_idx int, sample_idx int"


def made(frame):
    rows = [(d, l, 0, i, 3 - i, [float(d), float(l), 0.0]) for d in (1, 2, 10) for l in (0, 2, 11) for i in (0, 1)]
    return frame(rows, f"{KEYS}, n_tokens int, vec array<float>")


def test_keys_and_text(frame):
    rows = made(frame).where("doc_id = 10 AND line_no = 11 AND sample_idx = 1")
    assert rows.select(samples.sample_key()).first()[0] == "10-11-0-1"
    assert samples.render(rows).first()[0] == "10-11-0-1\t10.0;11.0;0.0"


def test_rescan_of_written_samples(spark, frame, tmp_path):
    samples.render(made(frame)).write.text(str(tmp_path / "samples"))
    back = {r.sample_key: list(r.tokens) for r in samples.parse(spark.read.text(str(tmp_path / "samples"))).collect()}
    assert len(back) == 18 and back["2-11-0-0"] == ["2.0", "11.0", "0.0"]
    line = "shard_0-0-0-1\t438.0;3055.0;1962.0"
    spaces = "shard_0-0-0-1\t438.0 3055.0 1962.0"
    for text in (line, spaces):
        row = samples.parse(frame([(text,)], "value string")).first()
        assert (row.sample_key, " ".join(row.tokens)) == ("shard_0-0-0-1", "438.0 3055.0 1962.0")


def test_first_per_key(frame):
    rows = [("a", [2.0]), ("a", [1.0])] + [("hot", [5.0])] * 200 + [("b", [3.0])]
    once = samples.first_per_key(frame(rows, "sample_key string, vec array<float>"), ["sample_key"])
    assert {r.sample_key: list(r.vec) for r in once.collect()} == {"a": [1.0], "hot": [5.0], "b": [3.0]}


def test_copies_collapse_before_the_join(frame):
    """Before, all copies went through the join and collapsed after it."""
    rows = frame([(1, 0, [2.0], "x"), (1, 0, [2.0], "x"), (1, 0, None, None), (None, 0, [1.0], "n"), (2, None, [1.0], "n"), (2, 0, None, None)], "a int, b int, vec array<float>, c string")
    once = samples.first_per_key(rows, ["a", "b"])
    plan = once._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Join") < plan.index("HashAggregate")
    found = once.collect()
    assert sorted((r.a, r.b) for r in found) == [(1, 0), (2, 0)] and once.columns == ["a", "b", "vec", "c"]
    assert all((r.vec, r.c) in ([([2.0], "x"), (None, None)] if r.a == 1 else [(None, None)]) for r in found)
    marks = {(r.a, r.c): r.m for r in rows.select("a", "c", F.xxhash64("vec", "c").alias("m")).collect()}
    assert [r.c for r in found if r.a == 1] == [min(("x", None), key=lambda c: marks[1, c])]


def test_order_is_numeric(frame):
    rows = samples.ordered(made(frame)).collect()
    keys = [(r.doc_id, r.line_no, r.sentence_idx, r.sample_idx) for r in sorted(rows, key=lambda r: r.position)]
    assert keys == sorted(keys) and [r.position for r in sorted(rows, key=lambda r: r.position)] == list(range(1, 19))


def test_weights_and_replicas(frame):
    rows = frame([(1, 0, 0, 0, 2, [1.0, 2.0])], f"{KEYS}, n_tokens int, vec array<float>")
    assert rows.select(samples.text_length(rows)).first()[0] == len("1.0 2.0")
    assert samples.replicate_by_length(rows).count() == 7


def test_shards_are_even_and_whole(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("xy").alias("text"))
    for shard in (sharding.shard_by_id("doc_id", 4), sharding.shard_by_hash(["doc_id"], 4)):
        sizes = sharding.shard_sizes(rows.withColumn("shard_id", shard), "text").collect()
        assert sorted(r.shard_id for r in sizes) == [0, 1, 2, 3]
        assert sum(r.n_rows for r in sizes) == 4000 and all(850 < r.n_rows < 1150 for r in sizes)
        assert sum(r.n_bytes for r in sizes) == 8000


def test_token_ids_from_text(frame):
    cases = {"438.0": 438, "7": 7, "1.5E3": 1500, "3.99": 3, "": None, "UNK": None, "-4.0": -4, "-3.7": -4, "+7": 7, ".5": 0, "5.": 5, ".": None, "+": None, "e5": None, "1e99": None, "NaN": None, "12x": None}
    rows = frame([(t,) for t in cases], "raw string").select("raw", rejects.token_id_from_text(F.col("raw")).alias("id"))
    assert {r.raw: r.id for r in rows.collect()} == cases


def test_rejects_and_good_rows_make_up_the_input(frame):
    raw = ["1.0", "2.0", "9.0", "UNK", "", "1e99"]
    known = frame([(1,), (2,)], "token_id int")
    good, bad = rejects.split_rejects(frame([(t,) for t in raw], "raw string"), known)
    assert {r.raw: r.token_id for r in good.collect()} == {"1.0": 1, "2.0": 2}
    assert {r.raw: r.reason for r in bad.collect()} == {
        "9.0": "unknown id", "UNK": "not a number", "": "not a number", "1e99": "unknown id",
    }


def test_float_text_round_trip(frame):
    rows = frame([([0.065905005, 1e-4, -3.5],)], "vec array<float>")
    assert rows.select(V.parse(V.render(F.col("vec")))).first()[0] == rows.first()[0]


def test_draws_follow_weights_and_reruns_agree(frame):
    rows = frame([(k, 0, 0, 0, float([0, 1, 2, 10][k % 4])) for k in range(2000)], "doc_id long, line_no int, sentence_idx int, sample_idx int, w double")
    mean, epochs = 3.25, 4

    def drawn(seed):
        return Counter(r.doc_id for r in samples.weighted_draws(rows, F.col("w"), epochs, seed).collect())

    found = drawn(1)
    assert found == drawn(1) and found != drawn(2)
    for k, w in enumerate([0, 1, 2, 10]):
        times = [found[i] for i in range(k, 2000, 4)]
        low, high = epochs * int(w / mean), epochs * (int(w / mean) + 1)
        assert all(low <= t <= high for t in times) and abs(sum(times) / 500 - epochs * w / mean) < 0.2
    assert samples.weighted_draws(rows, F.col("w"), 2).columns == rows.columns
    assert samples.weighted_draws(rows.limit(0), F.col("w"), 2).count() == 0


def test_bytes_of_a_text_without_a_pattern(frame):
    """Before, a regular expression cut the text's hexadecimal form and each piece was converted."""
    from wordloom.plans import queries

    texts = ["a", "", "é€😀 \t~", "\x00\x7f\x80ÿ", None]
    made = frame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", queries._byte_ids(F.col("t")).alias("ids"))
    assert {r.k: r.ids for r in made.collect()} == {k: None if t is None else list(t.encode()) for k, t in enumerate(texts)}
    assert "regexp" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_ids_beyond_single_precision_are_read_whole(frame):
    """Before, 16777217 was read as 16777216."""
    cases = {"1.6777217E7": 16777217, "16777216.0": 16777216, "1.6777215E7": 16777215, "2147483647": 2147483647, "2147483648": None, "-16777217": -16777217, "1e39": None}
    rows = frame([(t,) for t in cases], "raw string").select("raw", rejects.token_id_from_text(F.col("raw")).alias("id"))
    assert {r.raw: r.id for r in rows.collect()} == cases


@pytest.mark.parametrize("name", ["pad_windows", "samples_tsv", "samples_parse", "token_id_from_text", "samples_dedup", "samples_rescan", "cooccurrence_totals", "embedding_coverage"])
def test_a_dictionary_beyond_single_precision_gives_samples(spark, tmp_path, monkeypatch, name):
    """Before, the first sample with an id over the bound (2^24) raised an error. Both number types spell an id alike."""
    from wordloom.plans import queries

    texts = [(k, " ".join(f"w{(k * k + j) % 13}" for j in range(12))) for k in range(6)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    single = queries.QUERIES[name](spark, str(tmp_path)).collect()
    monkeypatch.setattr(samples, "EXACT_FLOAT", 4)
    double = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(map(str, double)) == sorted(map(str, single)) and single
