"""The registered queries: each reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.functions import vectors as V
from wordloom.operators import cells, cooccurrence, counts, dictionary, lines, neighbours, rejects, samples, sharding, word2vec
from wordloom.plans.pipeline import Settings
from wordloom.session import checkpoint_dir, stage_table
from wordloom.sources import readers
from wordloom.sources.writers import write_table

Query = Callable[[SparkSession, str], DataFrame]

# The windows of the registered queries, and what the sampled vectors are cut into.
SIZE, STRIDE, PAD = 10, 3, 0
SHARDS = 4
MIN_COUNT = 3
CUT_START, CUT_LENGTH = 16, 32
FOLD_CHUNK = 3
DIVISOR = 7

# The models of the registered queries: one epoch over all words, nearest words through cells.
MODEL = Settings(dim=20, epochs=1, min_count=1, n_models=2, nearest_by="cells")

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Shared steps


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return readers.table(spark, f"{sf}/documents.parquet", "doc_id", "text")


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return readers.table(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding", "label")


def _lines(spark, sf):
    return lines.to_lines(_documents(spark, sf))


def _words(spark, sf):
    return lines.to_words(_lines(spark, sf))


def _sentences(spark, sf, pattern=T.SENTENCE_BREAK):
    return lines.to_sentences(_lines(spark, sf), pattern)


def _tokens(spark, sf):
    return lines.to_tokens(_sentences(spark, sf))


def _known(spark, sf):
    return dictionary.build_dictionary(_tokens(spark, sf))


def _sentence_ids(spark, sf, known):
    """Lines and sentences are numbered within their document, so no two sentences share their keys if no two documents do."""
    ids = spark.read.parquet(f"{sf}/documents.parquet").groupBy("doc_id").agg(F.count("*").alias("k"))
    once = ids.where("k > 1 or doc_id is null").isEmpty()
    return dictionary.sentence_token_ids(_sentences(spark, sf), known, once=once)


def _samples(spark, sf):
    known = _known(spark, sf)
    return samples.sliding_windows(_sentence_ids(spark, sf, known), SIZE, STRIDE, PAD, samples.number_for(known))


def _byte_ids(text):
    """The bytes of a text as numbers, through an alphabet with a letter for each byte."""
    letters = F.decode(text.cast("binary"), "ISO-8859-1")
    return F.when(F.length(letters) > 0, F.transform(F.split(letters, ""), lambda c: F.ascii(c))).when(letters == "", F.array().cast("array<int>"))


def _sentence_bytes(spark, sf):
    """(keys, token_ids): the bytes of each sentence's words, without the spaces between them."""
    worded = _sentences(spark, sf).where(F.rtrim("sentence") != "")
    return worded.select(*samples.KEY[:3], _byte_ids(F.replace("sentence", F.lit(" "))).alias("token_ids"))


def _rendered_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vec_str", V.render(F.col("vec"))).drop("vec")


# Lines, words, sentences


@query
def text_lines(spark, sf):
    return _lines(spark, sf)


@query
def word_explode(spark, sf):
    return _words(spark, sf)


@query
def sentence_split(spark, sf):
    return _sentences(spark, sf)


@query
def sentence_split_punct(spark, sf):
    return _sentences(spark, sf, T.PUNCTUATION_BREAK)


@query
def sentence_index(spark, sf):
    return lines.sentence_extent(_lines(spark, sf))


@query
def empty_sentences(spark, sf):
    return lines.without_tokens(_sentences(spark, sf, T.PUNCTUATION_BREAK)).select(*samples.KEY[:3])


@query
def shard_assign(spark, sf):
    sharded = _documents(spark, sf).withColumn("shard_id", sharding.shard_by_id("doc_id", SHARDS))
    return sharding.shard_sizes(sharded, "text")


@query
def shard_by_bytes(spark, sf):
    """Runs of documents of equal bytes."""
    sized = _documents(spark, sf).select("doc_id", F.octet_length("text").alias("bytes"))
    return sharding.shard_by_bytes(sized, ["doc_id"], F.col("bytes"), SHARDS).select("doc_id", "shard_id")


# Counts and vocabulary


@query
def word_count(spark, sf):
    return counts.word_count(_words(spark, sf))


@query
def word_count_all(spark, sf):
    """All text tables as one input, as files of one folder are."""
    corpora = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id", "pages": "page_id"}
    texts = [
        readers.table(spark, f"{sf}/{name}.parquet", key, "html" if name == "pages" else "text").toDF("doc_id", "text")
        for name, key in corpora.items()
    ]
    return counts.word_count(lines.to_words(lines.to_lines(reduce(DataFrame.unionAll, texts))))


@query
def vocab_min_count(spark, sf):
    return counts.word_count(_words(spark, sf), MIN_COUNT)


@query
def vocab_size(spark, sf):
    return counts.vocab_size(counts.word_count(_words(spark, sf)))


def _counts_with_ids(spark, sf):
    """Word counts with the id text; the empty word has no id."""
    ids = F.coalesce(F.col("token_id").cast("string"), F.lit("")).alias("ids_str")
    return dictionary.count_with_ids(_words(spark, sf)).select("word", "n", ids)


@query
def word_count_with_ids(spark, sf):
    return _counts_with_ids(spark, sf)


def _sink_lines(spark, df, form):
    """What a sink writes, read back line by line."""
    path = f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"
    write_table(df, path, form)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def word_count_csv(spark, sf):
    return _sink_lines(spark, _counts_with_ids(spark, sf), "csv")


@query
def vocab_size_legacy(spark, sf):
    return counts.vocab_size_by_id_text(_counts_with_ids(spark, sf), F.col("ids_str"))


@query
def encode_dictionary(spark, sf):
    return dictionary.build_dictionary(_tokens(spark, sf)).select("word", "token_id")


@query
def decode_tokens(spark, sf):
    tokens = _tokens(spark, sf)
    known = dictionary.build_dictionary(tokens)
    used = dictionary.sentence_token_ids(tokens, known).select(F.explode("token_ids").alias("token_id"))
    return dictionary.decode(used, known)


# Bytes as token ids


@query
def encode_bytes(spark, sf):
    distinct = counts.word_count(_words(spark, sf)).select("word")
    return distinct.select("word", F.array_join(_byte_ids(F.col("word")).cast("array<string>"), ";").alias("ids_str"))


@query
def decode_bytes(spark, sf):
    used = _sentence_bytes(spark, sf).select(F.explode("token_ids").alias("token_id")).distinct()
    text = F.make_valid_utf8(F.unhex(F.lpad(F.hex("token_id"), 2, "0")).cast("string"))
    return used.select("token_id", text.alias("token"))


@query
def sliding_windows_bytes(spark, sf):
    return _rendered_vectors(samples.sliding_windows(_sentence_bytes(spark, sf), SIZE, STRIDE, PAD).drop("n_tokens"))


# Token ids and samples


@query
def sentence_token_ids(spark, sf):
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ";")
    return _sentence_ids(spark, sf, _known(spark, sf)).select(*samples.KEY[:3], ids.alias("ids_str"))


@query
def sliding_windows(spark, sf):
    return _rendered_vectors(_samples(spark, sf)).drop("n_tokens")


@query
def pad_windows(spark, sf):
    n_pads = F.lit(SIZE) - F.col("n_tokens")
    return _rendered_vectors(_samples(spark, sf)).withColumn("n_pads", n_pads).where("n_pads > 0").drop("n_tokens")


@query
def sample_keys(spark, sf):
    return _samples(spark, sf).select(samples.sample_key().alias("sample_key"))


@query
def samples_dedup(spark, sf):
    once = _rendered_vectors(_samples(spark, sf)).drop("n_tokens")
    twice = once.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return samples.first_per_key(twice, samples.KEY).select(samples.sample_key().alias("sample_key"), "vec_str")


@query
def samples_tsv(spark, sf):
    keyed = _samples(spark, sf).select(samples.sample_key().alias("sample_key"), "vec")
    return _sink_lines(spark, keyed, "tsv")


@query
def samples_ordered(spark, sf):
    return samples.ordered(_samples(spark, sf))


@query
def sample_weight_legacy(spark, sf):
    made = _samples(spark, sf)
    return made.select(samples.sample_key().alias("sample_key"), samples.text_length(made).alias("weight"))


@query
def samples_parse(spark, sf):
    parsed = samples.parse(samples.render(_samples(spark, sf)))
    return parsed.select(
        "sample_key",
        F.size("tokens").alias("n_tokens"),
        rejects.token_id_from_text(F.element_at("tokens", 1)).alias("first_id"),
        rejects.token_id_from_text(F.element_at("tokens", -1)).alias("last_id"),
    )


@query
def samples_rescan(spark, sf):
    """Sample files that also hold the corpus's own lines, with and without a key, read again: good lines and rejects by reason."""
    path = f"{checkpoint_dir(spark)}/mixed-{uuid.uuid4().hex}"
    plain = _lines(spark, sf).select(F.explode(F.array("line", F.concat_ws("\t", "doc_id", "line"))))
    samples.render(_samples(spark, sf)).unionAll(plain).write.text(path)
    good, bad = samples.scan_text(readers.text_files_with_offset(spark, path), SIZE)
    judged = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return judged.groupBy("reason").agg(F.count("*").alias("n"))


@query
def token_id_from_text(spark, sf):
    parsed = samples.parse(samples.render(_samples(spark, sf)))
    raw = parsed.select(F.explode("tokens").alias("raw")).distinct()
    return raw.select("raw", rejects.token_id_from_text(F.col("raw")).alias("token_id"))


@query
def reject_bad_tokens(spark, sf):
    return _split_words(spark, sf)[1]


def _split_words(spark, sf):
    raw = counts.word_count(_words(spark, sf)).withColumnRenamed("word", "raw")
    return rejects.split_rejects(raw, dictionary.build_dictionary(_tokens(spark, sf)))


@query
def accept_good_tokens(spark, sf):
    return _split_words(spark, sf)[0]


# Vectors


def _scaled(vector: str = "embedding"):
    """Whole thousandths as floats: their text is the same in every engine."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1000).cast("float"))


def _neighbours_by_id(spark, sf):
    """Each vector beside the one with the next id."""
    left = _embeddings(spark, sf).select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a"))
    right = _embeddings(spark, sf).select(
        (F.col("vec_id") - 1).alias("a_id"), F.col("vec_id").alias("b_id"), F.col("embedding").alias("b")
    )
    return left.join(right, "a_id")


def _positions(df, key, vector):
    return df.select(key, F.posexplode(vector).alias("pos", "value"))


@query
def vector_to_string(spark, sf):
    return _embeddings(spark, sf).select("vec_id", V.render(_scaled()).alias("text"))


@query
def vector_parse(spark, sf):
    parsed = _embeddings(spark, sf).select("vec_id", V.parse(V.render(_scaled())).alias("vec"))
    total = F.aggregate("vec", F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))
    return parsed.select("vec_id", F.size("vec").alias("n"), total.alias("total"))


@query
def vector_add(spark, sf):
    pairs = _neighbours_by_id(spark, sf)
    return _positions(pairs.select(F.col("a_id").alias("vec_id"), V.add(F.col("a"), F.col("b")).alias("v")), "vec_id", "v")


@query
def vector_divide(spark, sf):
    divided = _embeddings(spark, sf).select("vec_id", V.divide(F.col("embedding"), F.lit(DIVISOR)).alias("v"))
    return _positions(divided, "vec_id", "v")


@query
def vector_slice(spark, sf):
    cut = _embeddings(spark, sf).select("vec_id", V.cut(F.col("embedding"), CUT_START, CUT_LENGTH).alias("v"))
    return _positions(cut, "vec_id", "v")


@query
def vector_copy_range(spark, sf):
    copied = _embeddings(spark, sf).select("vec_id", V.copy_range(F.col("embedding"), CUT_START, CUT_LENGTH).alias("v"))
    return _positions(copied, "vec_id", "v")


@query
def vector_fold_compare(spark, sf):
    """Pieces of three elements: the fold of a whole long vector is zero in single precision."""
    pairs = _neighbours_by_id(spark, sf)
    pieces = pairs.select(
        "a_id", "b_id", F.posexplode(F.arrays_zip(V.chunks(F.col("a"), FOLD_CHUNK).alias("a"), V.chunks(F.col("b"), FOLD_CHUNK).alias("b"))).alias("piece", "p")
    )
    return pieces.select("a_id", "b_id", "piece", V.compare(F.col("p.a"), F.col("p.b")).alias("cmp"))


@query
def vector_mean(spark, sf):
    means = word2vec.mean_vectors(_embeddings(spark, sf), "label", "embedding")
    return means.select("label", F.posexplode("mean").alias("pos", "mean")).withColumn("mean", F.round("mean", 6))


@query
def nearest_words(spark, sf):
    return neighbours.nearest(_embeddings(spark, sf), "vec_id", "embedding")


@query
def nearest_words_recall(spark, sf):
    """Whether the index finds nine tenths of the nearest rows of every id divisible by 50 among all rows."""
    given, asked = _embeddings(spark, sf), F.col("vec_id") % 50 == 0
    found = cells.nearest_by_cells(given, "vec_id", "embedding", queries=asked)
    share = cells.found_share(found, nearest_words(spark, sf).where(asked), "vec_id")
    return share.select("n_queries", "n_exact", (F.col("n_found") >= 0.9 * F.col("n_exact")).alias("reached"))


def _neighbour_counts(spark, sf):
    labels = _embeddings(spark, sf).select("vec_id", "label")
    named = nearest_words(spark, sf).join(labels, "vec_id")
    return neighbours.neighbour_frequency(named, "label")


@query
def neighbour_freq(spark, sf):
    return _neighbour_counts(spark, sf)


@query
def neighbour_top3(spark, sf):
    return neighbours.most_frequent(_neighbour_counts(spark, sf), "label").drop("n")


def _merged(spark, sf):
    """The final table from given vectors: labels as tokens, labels of the nearest vectors as neighbours."""
    given = _embeddings(spark, sf)
    labels = given.select(F.col("vec_id").alias("near_id"), F.col("label").alias("near_label"))
    named = nearest_words(spark, sf).join(labels, "near_id").groupBy("vec_id").agg(F.collect_list("near_label").alias("near"))
    messages = given.join(named, "vec_id").select(F.col("label").alias("token_id"), F.col("embedding").alias("vec"), "near")
    names = given.select(F.col("label").alias("token_id")).distinct().withColumn("token", F.concat(F.lit("label "), "token_id"))
    return word2vec.embedding_table(messages, names)


@query
def embedding_merge(spark, sf):
    table = _merged(spark, sf)
    positions = table.select("token_id", "token", F.posexplode("vec").alias("pos", "value"), F.array_join("near", ", ").alias("near_str"))
    return positions.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query
def embeddings_csv(spark, sf):
    """The sink's lines with the vector as whole hundredths, whose text is the same in every engine."""
    hundredths = F.transform("vec", lambda x: F.floor(x.cast("double") * 100).cast("int"))
    rows = _merged(spark, sf).select("token", hundredths.alias("vec"), F.array_join("near", ", ").alias("near"))
    return _sink_lines(spark, rows, "csv")


# Models: short settings, whole corpus


def _sharded_samples(spark, sf):
    """Samples over dictionary ids, sharded by document."""
    sharded = _samples(spark, sf).withColumn("shard_id", sharding.shard_by_id("doc_id", MODEL.n_models))
    return stage_table(sharded, "samples", ["shard_id"])


def _model_settings():
    return {name: getattr(MODEL, name) for name in ("dim", "epochs", "window", "min_count", "seed", "partitions")}


def _fitted(spark, sf, k=None):
    return word2vec.fit_shards(_sharded_samples(spark, sf), MODEL.n_models, k, **_model_settings())


def _finite(vector="vec"):
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


@query
def word2vec_vectors(spark, sf):
    return word2vec.fit_vectors(_sharded_samples(spark, sf), **_model_settings())


@query
def word2vec_coverage(spark, sf):
    return word2vec_vectors(spark, sf).select("token_id", F.size("vec").alias("dim"), _finite().alias("finite"))


@query
def cooccurrence_totals(spark, sf):
    """For each word the distinct words within its window, their places, and how many have a positive weight."""
    pairs = stage_table(cooccurrence.cooccurrence(_samples(spark, sf), MODEL.window), "pairs")
    weights = cooccurrence.ppmi(pairs).groupBy("a").agg(F.count("*").alias("n_positive"))
    totals = pairs.groupBy("a").agg(F.count("*").alias("n_near"), F.sum("n").alias("n_places"))
    joined = totals.join(weights, "a", "left")
    return joined.select(F.col("a").alias("token_id"), "n_near", "n_places", F.coalesce("n_positive", F.lit(0)).alias("n_positive"))


@query
def counts_coverage(spark, sf):
    """Vectors from co-occurrence counts: every word has one, of finite numbers."""
    made = cooccurrence.fit_counts(_samples(spark, sf), MODEL.dim, MODEL.window, MODEL.min_count, MODEL.seed)
    return made.select("token_id", F.size("vec").alias("dim"), _finite().alias("finite"))


@query
def embedding_aligned(spark, sf):
    """The given vectors and a copy on other axes, reversed with every second sign changed, merge back to the given ones."""
    given = _embeddings(spark, sf).select(F.col("vec_id").alias("token_id"), F.col("embedding").alias("vec"))
    other = F.transform(F.reverse("vec"), lambda x, i: F.when(i % 2 == 0, x).otherwise(-x))
    both = given.withColumn("shard_id", F.lit(0)).unionByName(given.withColumn("vec", other).withColumn("shard_id", F.lit(1)))
    merged = word2vec.merge_shards(both, align=True).withColumnRenamed("vec", "merged").join(given, "token_id")
    near = F.forall(F.zip_with("merged", "vec", lambda x, y: F.abs(x - y) < 1e-4), lambda same: same)
    return merged.select(F.col("token_id").alias("vec_id"), "n_models", near.alias("same"))


@query
def word2vec_ensemble(spark, sf):
    return word2vec.merge_shards(_fitted(spark, sf))


@query
def ensemble_coverage(spark, sf):
    return word2vec_ensemble(spark, sf).select("token_id", "n_models", F.size("vec").alias("dim"), _finite().alias("finite"))


@query
def embedding_table(spark, sf):
    tokens = _tokens(spark, sf)
    known = dictionary.build_dictionary(tokens)
    samples_ = samples.sliding_windows(dictionary.sentence_token_ids(tokens, known), SIZE, STRIDE, PAD, samples.number_for(known))
    sharded = stage_table(samples_.withColumn("shard_id", sharding.shard_by_id("doc_id", MODEL.n_models)), "samples", ["shard_id"])
    fitted = stage_table(word2vec.fit_shards(sharded, MODEL.n_models, MODEL.nearest, MODEL.nearest_by, MODEL.recall, **_model_settings()), "fitted")
    return word2vec.embedding_table(fitted, dictionary.decode(fitted, known), MODEL.kept)


@query
def embedding_coverage(spark, sf):
    """How many neighbours each token of the final table has."""
    return embedding_table(spark, sf).select("token_id", "token", F.size("near").alias("n_near"))
