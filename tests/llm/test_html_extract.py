import pytest

from wordloom.llm import html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><p>no</p>";</script></head><body class="home2">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<div id="cookie-notice"><p>We use cookies.</p></div><div class="layout12"><div class="post-body">
<h1>Fish &amp; chips&nbsp;&#33;</h1><p><b>First   bit<br>goes
on &lt;here&gt;.<p>Second 1 < 2 &copy bit.</p><form><p>Name</p><input></form><div class="ad-box">Buy</div><ul><li>one</li><li>two</li></ul>
</div><aside>Side</aside><div class="comments"><p>Nice one, said a reader at some length, as readers do.</p></div></div><footer>&copy; us</footer></body></html>"""
TEXT = "Fish & chips !\nFirst bit goes on <here>.\nSecond 1 < 2 © bit.\none\ntwo"


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    return {r.page_id: r.text for r in html_extract.extract(pages).collect()}


def test_the_article_and_nothing_else(spark):
    assert texts(spark, [(1, "http://a.example/1", PAGE)]) == {1: TEXT}


def test_pages_follow_their_hosts_vote(spark):
    good = "<body><div class='wrap3'><div class='text7'><p>{}</p></div><div class='box'><p>{}</p></div></div></body>"
    rows = [(k, f"http://a.example/{k}", good.format("The story goes on and on and on. " * 5, "short")) for k in range(8)]
    rows.append((8, "http://a.example/8", good.format("A brief story.", "A box that is far longer than the story of this page. " * 9)))
    rows.append((9, "http://b.example/9", good.format("A brief story.", "A box that is far longer than the story of this page. " * 9)))
    got = texts(spark, rows)
    assert got[8] == "A brief story."
    assert got[9].startswith("A box")


def test_odd_pages(spark):
    rows = [
        (1, "http://a.example/", None),
        (2, None, ""),
        (3, "x", "plain text\n only &amp; no tags"),
        (4, "http://c.example/", "<p>open <b>tags <i>only"),
        (5, "http://d.example/", "<script>never closed <p>x</p>"),
        (6, None, "<nav><p>just a menu</p></nav>"),
        (7, "http://e.example/", "<article><p>" + "long text " * 40000 + "</p></article>"),
        (8, "http://f.example/", "<div title='a > b' class=\"x\">quoted</div>"),
        (9, "http://g.example/", "<div " + "a='" * 5000),
        (10, "http://h.example/", "</div></p>ends first<p>then"),
        (10, "http://h.example/", "</div></p>ends first<p>then"),
    ]
    got = texts(spark, rows)
    assert got[1] == got[2] == got[5] == got[6] == ""
    assert got[3] == "plain text only & no tags"
    assert got[4] == "open tags only"
    assert got[7] == ("long text " * 40000).strip()
    assert got[8] == "quoted"
    assert got[10] == "ends first\nthen"


def test_repeats_clashing_columns_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", PAGE, "p", "t")] * 2, "page_id bigint, url string, html string, path string, text string")
    assert [r.text for r in html_extract.extract(pages).collect()] == [TEXT] * 2
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_joined_without_a_broadcast(spark, monkeypatch):
    from wordloom.llm import decontam

    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert texts(spark, [(1, "http://a.example/1", PAGE), (2, None, PAGE)]) == {1: TEXT, 2: TEXT}


@pytest.mark.parametrize("tag", ["nav", "header", "footer", "aside", "form", "script", "style", "button"])
def test_dropped_elements(tag):
    found = html_extract.blocks(f"<article><p>a</p><{tag}>x</{tag}><p>b</p></article>")
    assert [b.text for b in found.blocks] == ["a", "b"]


STORY = "<p>The story goes on and on and on, as stories do.</p>"
TOLD = "The story goes on and on and on, as stories do."
SIDE = "<div class='sidebar'><p>Side.</p></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content-sidebar-wrap'><div class='text'>{STORY}</div>{SIDE}</div>",
        f"<div class='page has-sidebar'><article>{STORY}</article>{SIDE}</div>",
        f"<div class='header-banner'><main>{STORY}</main>{SIDE}</div>",
        f"<div id='social'><div>{STORY}</div>{SIDE}</div>",
        f"<div class='layout'><article>{STORY * 2}</article><div class='related'><article><p>Another story.</p></article></div></div>",
        f"<div>{STORY}</div><div class='comments'><p>{'A reader wrote more than the author did. ' * 9}</p></div>",
    ],
)
def test_marked_containers_that_hold_the_article(spark, page):
    assert set(texts(spark, [(1, "http://a.example/1", page)])[1].split("\n")) == {TOLD}


def test_title_lead_and_lists_stay_with_the_body(spark):
    body = STORY * 9
    rows = [
        (1, "http://a.example/1", f"<body><div class='post'><h1>Title</h1><p>The lead of the story.</p><div class='body'>{body}</div></div></body>"),
        (2, "http://b.example/1", f"<body><div class='w'><div class='t'><h1>Title</h1></div><div class='l'><p>The lead of the story.</p></div><div class='b'>{body}</div></div></body>"),
        (3, "http://c.example/1", f"<body><div><h1>Title</h1><p>The lead of the story.</p><table><tr><td>{body}</td></tr></table></div></body>"),
    ]
    want = "\n".join(["Title", "The lead of the story.", *[TOLD] * 9])
    assert texts(spark, rows) == {1: want, 2: want, 3: want}


def test_short_blocks_beside_the_body_stay(spark):
    page = f"<body>Skip<div class='wrap'><div class='post'><p>Hi all.</p><div class='body'>{STORY * 9}</div><p>The end.</p><p><a href='/'>More</a></p></div></div></body>"
    assert texts(spark, [(1, "http://a.example/1", page)])[1] == "\n".join(["Hi all.", *[TOLD] * 9, "The end."])
    page = f"<body><div class='layout'>Share<article>{STORY * 9}</article>Top</div></body>"
    assert texts(spark, [(1, "http://a.example/1", page)])[1] == "\n".join([TOLD] * 9)


def paths_of(page):
    """Blocks with their whole paths, by hand."""
    return [(page.path(b.node).split(">") if b.node else [], b) for b in page.blocks]


def brute_best(page):
    """Scores of all prefixes of all paths, the deepest good one, and the longest prefix shared with all that belongs to it."""
    found = paths_of(page)
    prefixes = {tuple(p[: k + 1]) for p, _ in found for k in range(len(p))}
    if not prefixes:
        return []
    tags = {p: p[-1].split(".")[0] for p in prefixes}
    scores = {
        q: sum(max(0, len(b.text) - 2 * b.linked) for p, b in found if tuple(p[: len(q)]) == q) * (1.5 if tags[q] in ("article", "main") else 1) for q in prefixes
    }
    good = [q for q in prefixes if scores[q] >= 0.8 * max(scores.values())]
    best = max(good, key=lambda q: (len(q), scores[q], -page.find(">".join(q))))
    root = next((best[: k + 1] for k in range(len(best)) if best[k].split(".")[0] in ("article", "main")), ())
    for p, b in found:
        if tuple(p[: len(root)]) == root and 2 * b.linked <= len(b.text) and (b.heading or len(b.text.encode()) >= 20):
            while tuple(p[: len(best)]) != best:
                best = best[:-1]
    return list(best)


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.45 or depth > 4:
            text = "word " * rng.choice([1, 2, 8, 30])
            out.append(rng.choice([f"<p>{text}</p>", f"<h2>{text}</h2>", text, f"<p><a href='/'>{text}</a></p>", f"</div><p>{text}"]))
        else:
            name = rng.choice(["a", "b1", "b2", "sidebar", "page has-sidebar", "comments", ""])
            tag = rng.choice(["div", "div", "section", "article", "main", "ul", "nav"])
            out.append(f"<{tag} class='{name}'>{random_page(rng, depth + 1)}</{tag}>")
    return "".join(out)


def test_votes_and_texts_equal_brute_force(spark):
    import random
    from collections import Counter, defaultdict

    rng = random.Random(3)
    rows = [(k, f"http://h{k % 9}.example/", f"<body>{random_page(rng)}</body>") for k in range(120)]
    voted, weight, wanted = defaultdict(Counter), Counter(), {}
    for k, url, text in rows:
        page = html_extract.blocks(text)
        best = ">".join(brute_best(page))
        assert page.path(html_extract.best_node(page)[0]) == best
        if best:
            voted[url][best] += 1
            weight[url, best] += int(html_extract.best_node(page)[1])
    for k, url, text in rows:
        page = html_extract.blocks(text)
        path = max(voted[url], key=lambda p: (voted[url][p], weight[url, p], p), default="").split(">") if voted[url] else []
        if not path or not any(p[: len(path)] == path for p, _ in paths_of(page)):
            path = brute_best(page)
        ends = path[-1].split(".")[0] if path else ""
        beside = path[:-1] if len(path) > 1 and path[-2].split(".")[0] not in ("html", "body") and ends not in ("article", "main") else None
        wanted[k] = "\n".join(b.text for p, b in paths_of(page) if p[: len(path)] == path or (p == beside and 2 * b.linked <= len(b.text)))
    assert texts(spark, rows) == wanted


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000,
        "<a href='" * 110_000,
        "<script " * 130_000,
        "<div>x" * 50_000,
        "<div class='sidebar'>x" * 50_000,
        "<div>" * 50_000 + "</nav>" * 100_000,
        "<div class='a'><p>x</p></div>" * 35_000,
        "<!--" * 250_000,
        "<" * 1_000_000,
        "<div" + " class=a" * 100_000 + ">x",
    ],
)
def test_hostile_pages_take_linear_time(page):
    import time

    begun = time.perf_counter()
    found = html_extract.blocks(page)
    html_extract.text_along(found, found.path(html_extract.best_node(found)[0]))
    assert time.perf_counter() - begun < 5
