"""Training samples: padded sliding windows over the token ids of each sentence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import vectors as V
from wordloom.operators.ranking import with_position
from wordloom.operators.rejects import EXACT_FLOAT, NUMBER

KEY = ["doc_id", "line_no", "sentence_idx", "sample_idx"]


def sliding_windows(
    sentence_ids: DataFrame, size: int = 10, stride: int = 3, pad: int = 0, number: str = "float"
) -> DataFrame:
    """(keys, sample_idx, n_tokens, vec): the ids of each window as numbers, padded to ``size``.

    ``n_tokens`` tells the ids from the pads by place, since the pad value may be an id as well.
    A dictionary of more than 2^24 words needs ``number="double"``; an id that single precision
    would change raises an error.
    """
    keys = [c for c in sentence_ids.columns if c != "token_ids"]
    cut = sentence_ids.select(
        *keys, F.posexplode(V.windows(F.col("token_ids"), size, stride)).alias("sample_idx", "ids")
    )
    vec = V.pad_right(F.col("ids"), size, F.lit(pad)).cast(f"array<{number}>")
    if number == "float":
        too_large = F.raise_error(F.lit("a token id is too large for single precision"))
        vec = F.when(F.array_max("ids") <= EXACT_FLOAT, vec).otherwise(too_large)
    return cut.select(*keys, "sample_idx", F.size("ids").alias("n_tokens"), vec.alias("vec"))


def number_for(dictionary: DataFrame) -> str:
    """The number type that holds all ids of a dictionary: ``float`` up to 2^24 words, else ``double``; both spell an id alike."""
    largest = dictionary.agg(F.max("token_id")).first()[0] or 0
    return "float" if largest <= EXACT_FLOAT else "double"


def sample_key(keys: list[str] = KEY) -> Column:
    """The key as one string, its parts joined by a dash."""
    return F.concat_ws("-", *keys)


def render(samples: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """(value): text lines of key, tab and the vector."""
    return samples.select(F.concat_ws("\t", sample_key(keys), V.render(F.col("vec"))).alias("value"))


def parse(lines: DataFrame) -> DataFrame:
    """(sample_key, tokens): the key and the ids as words from text lines, split by ``;`` or space."""
    fields = F.split("value", "\t")
    return lines.select(
        F.get(fields, F.lit(0)).alias("sample_key"), F.split(F.element_at(fields, -1), "[; ]").alias("tokens")
    )


def from_text(lines: DataFrame) -> DataFrame:
    """(sample_key, n_tokens, vec) from text lines, ready to fit on. Text does not tell pads from ids."""
    vec = F.transform("tokens", lambda t: t.try_cast("float"))
    return parse(lines).select("sample_key", F.size("tokens").alias("n_tokens"), vec.alias("vec"))


def scan_text(lines: DataFrame, size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of the lines (file, offset, line) of sample files; each line is in one of them.

    Good lines give (sample_key, n_tokens, vec), rejects (file, offset, line, reason): a line that is not a key, a tab and a
    vector, has an empty key or vector, holds something that is no number, or not ``size`` numbers where that is given.
    """
    fields = F.split("line", "\t", -1)
    read = lines.withColumn("sample_key", fields[0]).withColumn("tokens", F.split(F.get(fields, F.lit(1)), "[; ]", -1))
    reason = (
        F.when(F.size(fields) != 2, "not a key and a vector")
        .when(F.col("sample_key") == "", "no key")
        .when(F.get(fields, F.lit(1)) == "", "no vector")
        .when(F.exists("tokens", lambda t: ~t.rlike(NUMBER)), "not a number")
    )
    if size is not None:
        reason = reason.when(F.size("tokens") != size, "wrong length")
    read = read.withColumn("reason", reason)
    vec = F.transform("tokens", lambda t: t.cast("double")).alias("vec")
    good = read.where("reason is null").select("sample_key", F.size("tokens").alias("n_tokens"), vec)
    return good, read.where("reason is not null").select("file", "offset", "line", "reason")


def first_per_key(samples: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, for input that may repeat rows; null keys are left out.

    Of rows that share a key but not the rest, the one with the smallest hash stays. With numeric keys every step hashes: long
    text is neither compared nor sorted. Equal rows collapse in their task before they move, and are made once for both sides
    of the join.
    """
    others = [c for c in samples.columns if c not in keys]
    once = reduce(DataFrame.where, [F.col(k).isNotNull() for k in keys], samples).distinct()
    marked = once.withColumn("_mark", F.xxhash64(*others))
    least = marked.groupBy(*keys).agg(F.min("_mark").alias("_mark"))
    return marked.join(least.hint("shuffle_hash"), [*keys, "_mark"]).select(*keys, *others)


def ordered(samples: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """(keys, position) in text order, from 1. Sorts the keys only, not the vectors."""
    return with_position(samples.select(*keys), [F.asc(k) for k in keys], "position")


def text_length(samples: DataFrame) -> Column:
    """Characters of the vector's text with spaces: how often a sample counts under length weighting."""
    return F.length(V.render(samples["vec"], " "))


def replicate_by_length(samples: DataFrame) -> DataFrame:
    """Each sample once per character of its text; off in the pipeline."""
    times = F.array_repeat(F.lit(1), text_length(samples))
    return samples.withColumn("_copy", F.explode(times)).drop("_copy")


def weighted_draws(samples: DataFrame, weight: Column, epochs: int, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """Each sample as often as its weight over the mean weight says, for each of ``epochs`` epochs; nothing is written.

    In an epoch a sample of w times the mean weight is there floor(w) times, and once more with the chance of what is left of
    w, by a hash of its ``keys`` (``sample_key`` if there is one, else ``KEY``), the epoch and the seed. Reruns draw the same,
    and an epoch has about as many rows as there are samples, where copies by weight would be as many as characters.
    """
    keys = keys or (["sample_key"] if "sample_key" in samples.columns else KEY)
    weighed = samples.withColumn("_weight", weight.cast("double"))
    mean = weighed.agg(F.avg("_weight")).first()[0] or 1.0
    drawn = weighed.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("_weight", F.col("_weight") / mean)
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("_epoch"), *keys), F.lit(1 << 30)) / (1 << 30)
    times = F.floor(F.col("_weight") + 1 - chance).cast("int")  # chance < the rest of the weight: once more
    times = F.when(F.col("_weight") > 0, times).otherwise(0)
    copies = drawn.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times)))
    return copies.drop("_copy", "_epoch", "_weight")


def ids_of(samples: DataFrame, train_on_pad: bool = False) -> Column:
    """ARRAY<INT> of ids, the form a model is fitted on; pads are left out by place."""
    used = samples["vec"] if train_on_pad else F.slice(samples["vec"], F.lit(1), samples["n_tokens"])
    return used.cast("array<int>")


def words_of(samples: DataFrame, train_on_pad: bool = False) -> Column:
    """The same as ARRAY<STRING>."""
    return ids_of(samples, train_on_pad).cast("array<string>")
