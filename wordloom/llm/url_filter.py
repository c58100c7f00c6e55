"""URL filter: fixed rules first, gradient-boosted trees on lexical features for the rest.

Features are column expressions on the URL alone: lengths, depth, shares of characters, entropy,
parameter counts, and the share of blocked URLs among labelled ones with the same host suffix or first
path part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.session import stage_table

#: Most labelled URLs the trees are fitted to: those with the smallest hashes. Shares per part count all labelled URLs.
MAX_LABELLED = 10_000
#: Bytes of a part's counts that are broadcast; larger ones are joined, each row of them at ``SALTS`` places.
BROADCAST_BYTES, SALTS = 32 << 20, 16
TREES, DEPTH, SEED = 20, 4, 42
#: Labelled URLs that a suffix or path part seems to have besides its own, at the mean rate.
PRIOR = 10.0

# The rules as (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_and_path(url: str) -> tuple[Column, Column]:
    """Lower-cased host and path of a URL column; both empty without ``://`` or for null."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; of equally long ones that with the longer host."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _suffix(host: Column, labels: int) -> Column:
    return F.array_join(F.slice(F.reverse(F.split(host, r"\.")), 1, labels), ".")


#: What labelled shares are kept for: the host's last one, two and three labels, and the path's first part.
PARTS = ("suffix_1", "suffix_2", "suffix_3", "segment")


def _parts() -> dict[str, Column]:
    suffixes = {name: _suffix(F.col("host"), int(name[-1])) for name in PARTS if name[-1].isdigit()}
    return suffixes | {"segment": F.regexp_extract("path", "^/([^/]*)/", 1)}


LEXICAL = ("length", "host_length", "path_length", "depth", "digits", "upper", "hyphens", "dots", "entropy", "parameters", "secure", "fragment", "longest")


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the features of ``url``, ``host`` and ``path`` and the host suffixes; a null URL counts as empty."""
    u = F.coalesce(F.col("url").cast("string"), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    without = lambda c, chars: (F.length(c) - F.length(F.translate(c, chars, ""))).cast("double")
    share = lambda c: (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / n
    letters = F.array_distinct(F.filter(F.split(u, ""), lambda c: c != ""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    values = {
        "length": F.length(u).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": without(F.col("path"), "/"),
        "digits": without(u, "0123456789") / n,
        "upper": without(u, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n,
        "hyphens": without(u, "-_"),
        "dots": without(F.col("host"), "."),
        "entropy": F.aggregate(F.transform(letters, share), F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0)),
        "parameters": F.when(F.length(query) > 0, 1 + without(query, "&")).otherwise(0.0),
        "secure": u.startswith("https").cast("double"),
        "fragment": F.contains(u, F.lit("#")).cast("double"),
        "longest": F.array_max(F.transform(F.split("path", "[/._-]"), lambda s: F.length(s))).cast("double"),
    }
    return rows.withColumns(values | _parts())


def _look_up(rows: DataFrame, counts: DataFrame, part: str) -> DataFrame:
    """The counts of each row's part; a host of many rows is spread over ``SALTS`` tasks where they are joined."""
    if (counts.agg(F.sum(F.octet_length(part) + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(counts), part, "left")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    copies = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [part, "salt"], "left").drop("salt")


@dataclass
class UrlModel:
    """Trees and, per part, the labelled counts (part, n, blocked); ``trees`` is None without labels."""

    trees: GBTClassificationModel | None
    parts: dict[str, DataFrame]
    rate: float

    def features(self, rows: DataFrame, own: bool = False) -> DataFrame:
        """``own`` leaves a labelled row itself out of its parts' counts."""
        for part, counts in self.parts.items():
            less, label = (F.lit(1.0), F.col("label")) if own else (F.lit(0.0), F.lit(0.0))
            rows = _look_up(rows, counts, part)
            known = F.coalesce(F.col("n") - less, F.lit(0.0))
            rows = rows.withColumn(f"rate_{part}", (F.coalesce(F.col("blocked") - label, F.lit(0.0)) + PRIOR * self.rate) / (known + PRIOR))
            rows = rows.withColumn(f"seen_{part}", F.log1p(known)).drop("n", "blocked")
        names = [*LEXICAL, *(f"{name}_{part}" for name in ("rate", "seen") for part in self.parts)]
        return VectorAssembler(inputCols=names, outputCol="features").transform(rows)

    def block_probability(self, rows: DataFrame) -> DataFrame:
        """Adds ``block_probability``; 0 where nothing was learned."""
        if self.trees is None:
            return rows.withColumn("block_probability", F.lit(0.0))
        scored = self.trees.transform(self.features(rows))
        return scored.withColumn("block_probability", vector_to_array("probability")[1])


def train(labelled: DataFrame) -> UrlModel:
    """Trees from labelled URLs (url, blocked boolean, any other columns); rows with a null label are skipped.

    Shares of blocked URLs per host suffix and path part, and the mean rate, are counted over all distinct labelled URLs. The
    trees are fitted to at most ``MAX_LABELLED`` of these, those with the smallest hashes, so the model depends on the
    rows alone and not on their order or partitions. A URL with both labels counts as blocked.
    """
    spark = labelled.sparkSession
    rows = labelled.where("blocked is not null").select(F.col("url").cast("string"), F.col("blocked").cast("double").alias("label"))
    urls = stage_table(rows.withColumn("mark", F.xxhash64("url")).groupBy("mark", "url").agg(F.max("label").alias("label")), "labelled-urls")
    few = [(r.url, r.label) for r in urls.orderBy("mark", "url").limit(MAX_LABELLED).collect()]
    if not few:
        return UrlModel(None, {}, 0.0)
    host, path = host_and_path("url")
    placed = urls.select("label", host.alias("host"), path.alias("path"))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("part"), value.alias("value")) for name, value in _parts().items()))).alias("p")
    counted = placed.select("label", each).groupBy("p.part", "p.value").agg(F.count("*").cast("double").alias("n"), F.sum("label").alias("blocked"))
    counted = stage_table(counted, "labelled-parts")
    total, blocked = urls.agg(F.count("*"), F.sum("label")).first()
    counts = {part: counted.where(F.col("part") == part).select(F.col("value").alias(part), "n", "blocked") for part in PARTS}
    model = UrlModel(None, counts, blocked / total)
    frame = lexical(spark.createDataFrame(few, "url string, label double").select("url", "label", host.alias("host"), path.alias("path")))
    # at most MAX_LABELLED rows, in one order whatever the joins
    ready = model.features(frame, own=True).select("url", "features", "label").coalesce(1).sortWithinPartitions("url")
    model.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1).fit(ready)
    return model


def judge(pages: DataFrame, model: UrlModel, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_probability) per row of ``pages`` (page_id, url, any other columns).

    The verdict is the rule's, else ``block`` where the model's probability is above a half. A null or
    empty URL has empty host and path, fits no rule and is judged by the model like any other. Repeated
    rows give equal rows; an empty table none.
    """
    host, path = host_and_path("url")
    rows = lexical(pages.select("page_id", "url", host.alias("host"), path.alias("path")))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("block_probability") > 0.5, "block").otherwise("allow")
    scored = model.block_probability(rows.withColumn("found", rule))
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"), "block_probability")
