import re

import pytest

from wordloom.llm import url_filter

URLS = [
    None, "", "no scheme", "http://", "http://Net/", "https://a.NET/x", "http://net", "http://xnet/", "http://a.net?x=/", "http://example.net/en/1",
    "http://b.example.net/en", "http://m.Example.net/en/?a=1&b=2#f", "http://example.com/de/x", "http://example.com/DE/x", "https://example.com/fr/",
    "http://x.org/fr/1", "ftp://x.org:80/fr/1", "http://org/fr/", "see http://a.net/b://c", "http://a.net/x\ny?z", "http://" + "a" * 20000 + ".net/",
]


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule(host, path):
    fits = []
    for verdict, text in url_filter.RULES:
        name, rest = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


def url(k, bad):
    return f"http://site{k % 7}.{'bad' if bad else 'good'}.example/{'win-cash-now' if bad else 'article'}/{k ** (1 + k % 5)}"


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(url(k, k % 3 == 0), k % 3 == 0) for k in range(300)]
    return spark.createDataFrame([*rows, ("http://skipped.example/", None)], "url string, blocked boolean")


@pytest.fixture(scope="module")
def model(labelled):
    return url_filter.train(labelled)


def test_rules_hosts_and_paths(spark, model):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id bigint, url string, host string").repartition(3)
    for r in url_filter.judge(pages, model).collect():
        assert (r.host, r.path) == parts(URLS[r.page_id])
        text, verdict = rule(*parts(URLS[r.page_id]))
        assert r.rule == text
        assert r.verdict == (verdict or ("block" if r.block_probability > 0.5 else "allow"))


def test_unseen_urls_are_told_apart(spark, model):
    rows = [(k, url(k, k % 2)) for k in range(1000, 1100)]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), model).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in judged) >= 97


def test_order_and_partitions_of_the_labels_do_not_matter(spark, labelled, model):
    again = url_filter.train(labelled.orderBy("url", ascending=False).repartition(5))
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    scores = [sorted((r.page_id, r.block_probability) for r in url_filter.judge(pages, m).collect()) for m in (model, again)]
    assert scores[0] == scores[1]


def test_nothing_or_one_kind_to_learn_from(spark, labelled):
    pages = spark.createDataFrame([(1, "http://a.example/x")], "page_id bigint, url string")
    assert url_filter.judge(pages, url_filter.train(labelled.limit(0))).first().verdict == "allow"
    assert url_filter.judge(pages, url_filter.train(labelled.where("blocked"))).first().verdict == "block"


def test_empty_table(spark, model):
    assert url_filter.judge(spark.createDataFrame([], "page_id bigint, url string"), model).count() == 0


def test_shares_count_all_labels_beyond_those_the_trees_see(spark, labelled, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LABELLED", 40)
    few = url_filter.train(labelled.unionByName(labelled))  # repeated rows count once
    urls = {url(k, k % 3 == 0): k % 3 == 0 for k in range(300)}
    assert few.rate == sum(urls.values()) / len(urls)
    want = {}
    for u, bad in urls.items():
        host, path = parts(u)
        names = host.split(".")[::-1]
        first = path[1:].split("/")[0] if path.count("/") > 1 else ""
        for part, value in (("suffix_1", names[0]), ("suffix_2", ".".join(names[:2])), ("suffix_3", ".".join(names[:3])), ("segment", first)):
            n, blocked = want.get((part, value), (0, 0))
            want[part, value] = n + 1, blocked + bad
    got = {(part, r[part]): (r.n, r.blocked) for part, counts in few.parts.items() for r in counts.collect()}
    assert got == want


def test_joined_counts_score_like_broadcast_ones(spark, labelled, model, monkeypatch):
    pages = spark.createDataFrame([*enumerate(URLS), (1, URLS[1]), *((100 + k, url(k, k % 2)) for k in range(30))], "page_id bigint, url string")
    near = sorted(map(str, url_filter.judge(pages, model).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
    assert sorted(map(str, url_filter.judge(pages, model).collect())) == near
    assert sorted(map(str, url_filter.judge(pages, url_filter.train(labelled)).collect())) == near
