"""HTML extraction and revisit resolution: labelled pages, other templates, odd rows."""

import html as H
import re

from pyspark.sql import functions as F

from ledgerline.llm import html, warc


def reference(page):
    """The article element's blocks, for pages whose only markup is that of the tables."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [re.sub(r"\s+", " ", H.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_main_text_of_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = html.main_text(pages, html.learn(pages)).collect()
    assert len(got) == pages.count()
    for r in got:
        assert r.text == reference(r.html)


OTHER = """<html><head><title>T t</title></head><body><header class="top"><a href=/>Home page of the site</a></header>
<div id="menu"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class="cookie-notice">We use cookies on this site, accept them all now</div>
<div class="post"><h2>Title &amp; more</h2><p>First <b>para</b>graph with   many plain&nbsp;words in it, as articles have them.</p>
<div class="ad">Buy now, this is very cheap and good for you</div><p>Second paragraph, a &lt; b, and
still more words that follow here.<p>Third one without an end tag, also with several words<form><label>Name</label><input></form></div>
<aside>Read also these other stories</aside><section class="comments"><p>First! I am a reader and I have many words to say here, again and again.</p></section>
<footer>Copyright notice</footer></body></html>"""


def test_other_template_without_article(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = html.extract(OTHER, html.learn(pages))
    assert got == (
        "Title & more\n\nFirst paragraph with many plain words in it, as articles have them.\n\nSecond paragraph, a < b, and still more words that "
        "follow here.\n\nThird one without an end tag, also with several words"
    )


def test_edges_of_articles(spark, sf):
    """Lists, tables, link-rich paragraphs and a long aside at and inside the article's edges."""
    w = html.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    nav = "<html><body><nav><ul>" + "<li><a href=x>Menu</a></li>" * 9 + "</ul></nav>"
    foot = "<footer><p>Copyright notice here</p></footer></body></html>"
    items = "<ul>" + "".join(f"<li><a href=x>item {i}</a></li>" for i in range(8)) + "</ul>"
    cells = "<table><tr>" + "<td>cell</td>" * 6 + "</tr></table>"
    links = "<p>" + " ".join(f"<a href=x>link{i}</a>" for i in range(8)) + "</p>"
    aside = "<aside><ul>" + "<li><a href=x>Read this</a></li>" * 20 + "</ul></aside>"
    prose = "<p>" + "plain words of the article " * 12 + "</p>"
    words = lambda t: re.sub(r"<aside>.*</aside>|<[^>]*>", " ", t).split()
    for inner in (prose + items, items + prose, cells + prose + cells, links + prose + links, "<p>a short first part</p>" + aside + prose, prose + aside + "<p>a short last part</p>"):
        assert html.extract(f"{nav}<article>{inner}</article>{foot}", w).split() == words(inner), inner
    assert html.extract(f"{nav}{prose}{aside}{prose}{foot}", w).split() == words(prose + prose)


def test_wrappers_with_listed_words_keep_the_page():
    prose = "<p>" + "plain words of the article " * 12 + "</p>"
    learned = html.Weights(boilerplate={"div.wrap"})
    for wrapper in ("div class='no-sidebar'", "div id='content-with-header'", "form action=x", "div class=wrap", "body class=related"):
        tag = wrapper.split()[0]
        page = f"<html><{wrapper}><nav>Menu of the site</nav>{prose}<div class='sidebar'>Read this too</div></{tag}></html>"
        assert html.extract(page, learned).split() == re.sub("<[^>]*>", " ", prose).split(), wrapper


def test_slugs_and_compounds_inside_the_article_stay(spark, sf):
    """Ids made from headings and class names that only contain a listed word are no boilerplate."""
    w = html.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    prose = "<p>" + "plain words of the article " * 12 + "</p>"
    for part in (
        "<section id='search-methods'><p>" + "methods of the search " * 10 + "</p></section>", "<h2 id='related-work'>Related work</h2>",
        "<figure class='ad-hoc-figure'><img src=a><figcaption>What the figure shows</figcaption></figure>", "<h3 class='notice'>Notice of terms</h3>",
        "<div class='share-of-voters'><p>Half of all voters</p></div>", "<table id='social-costs'><tr><td>one</td><td>two</td></tr></table>",
    ):
        page = f"<nav>Menu of the site</nav><article>{prose}{part}{prose}</article><footer>Imprint</footer>"
        assert html.extract(page, w).split() == re.sub("<[^>]*>", " ", prose + part + prose).split(), part
    for part in ("<div class='ad'>Buy this</div>", "<div class='share-buttons'>Tell friends</div>", "<ul id='comments'><li>First!</li></ul>", "<p class='notice'>Cookies here</p>",
                 "<div class='cookie-notice top'>Accept</div>", "<section class='related posts'>More of it</section>"):
        page = f"<article>{prose}{part}{prose}</article>"
        assert html.extract(page, w).split() == re.sub("<[^>]*>", " ", prose + prose).split(), part


def test_boilerplate_without_end_tags(spark, sf):
    """What is skipped ends where HTML ends it, and every word after it stays."""
    w = html.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    prose = "<p>" + "plain words of the article " * 12 + "</p>"
    words = lambda t: re.sub("<[^>]*>", " ", t).split()
    cases = {
        f"{prose}<p class='notice'>We use cookies{prose}": prose + prose,
        f"{prose}<p class='notice'>We use <b>cookies<div>{prose}</div>": prose + prose,
        f"{prose}<ul><li class='share'>Tell friends<li>first item<li>second item</ul>{prose}": prose + "first item second item " + prose,
        f"<ul><li class='share'><a href=x>Tell friends<li>first item</ul>{prose}": "first item " + prose,
        f"<ul><li>one<li class='share'>Tell friends</ul>{prose}": "one " + prose,
        f"<table><tr><td class='ad'>Buy<td>cell</table>{prose}": "cell " + prose,
        f"<dl><dt class='ad'>Buy<dd>meaning</dl>{prose}": "meaning " + prose,
        f"<div class='ad'><p>Buy now<p>and here<ul><li>a<li>b</div>{prose}": prose,
        f"<div class='ad'>one <div>two</div> three</div>{prose}": prose,
        f"{prose}<div class='ad'>never closed": prose,
        f"<div class='ad'><i>Buy</div></i>{prose}": prose,
    }
    for inner, expected in cases.items():
        assert html.extract(f"<nav><ul><li>Menu<li>Page</nav><article>{inner}</article><footer>Imprint</footer>", w).split() == words(expected), inner


def test_best_region_is_the_best_of_all():
    import random

    rng = random.Random(5)
    assert html.best_region([]) == (0, 0) and html.best_region([-1.0, 0.0]) == (0, 0)
    for _ in range(600):
        scores = [rng.choice([1.0, 2.0, 7.0, -0.5, -1.0, -3.0, 0.0]) for _ in range(rng.randrange(1, 30))]
        begin, end = html.best_region(scores)
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        assert sum(scores[begin:end]) == max(0.0, max(sums))


def test_learned_boilerplate_needs_evidence(spark):
    page = "<div class='wrap'>words</div><article><p>the text</p></article>"
    for n, sure in ((4, False), (40, True)):
        pages = spark.createDataFrame([(i, page) for i in range(n)], "page_id bigint, html string")
        assert ("div.wrap" in html.learn(pages).boilerplate) == sure


def test_extraction_odd_pages():
    w = html.Weights()
    assert html.extract(None, w) == "" and html.extract("", w) == "" and html.extract("<p></p>", w) == ""
    assert html.extract("plain text only &am", w) == "plain text only &am"
    assert html.extract("<script>var a = '<p>no</p>'", w) == ""
    assert html.extract("<!-- open comment <p>no", w) == ""
    assert html.extract("a <b>c</b>d 1 < 2 & 3 <", w) == "a cd 1 < 2 & 3 <"
    assert html.extract("<p>one two three</p><p title='a > b'>four five six</p><p", w) == "one two three\n\nfour five six"
    assert html.extract("<nav>menu without end <article><p>the real text of this page</p></article>", w) == "the real text of this page"
    assert html.extract("<a " * 20000, w) == ""
    assert len(html.extract("<p>" + "word " * 200_000 + "</p>", w)) == 999_999


def test_main_text_columns_and_empty(spark):
    pages = spark.createDataFrame([(1, "<p>a b c</p>", "x", None), (1, "<p>a b c</p>", "x", None), (None, None, None, None)], "page_id bigint, html string, text string, url string")
    out = html.main_text(pages, html.learn(pages))
    assert out.columns == ["page_id", "html", "url", "text"]
    assert sorted(r.text for r in out.collect()) == ["", "a b c", "a b c"]
    assert html.main_text(pages.limit(0), html.learn(pages.limit(0))).collect() == []


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.org:80/a/b/?utm_source=x&b=2&a=1#f": "example.org/a/b?a=1&b=2",
        "https://user@example.org": "example.org",
        "https://example.org/?": "example.org",
        "https://m.example.org/A/?gclid=1": "m.example.org/A",
        "no url": None,
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string").select("url", warc.canonical_url(F.col("url")).alias("c"))
    assert {r.url: r.c for r in rows.collect()} == cases


def brute_resolve(rows, canon):
    out = {}
    for r in rows:
        if r["record_type"] != "revisit":
            continue
        c = canon[r["url"]]
        earlier = [x for x in rows if x["record_type"] == "response" and c and x["ts"] is not None and r["ts"] is not None and canon[x["url"]] == c and (x["ts"], x["record_id"]) < (r["ts"], r["record_id"])]
        out[r["record_id"]] = max(earlier, key=lambda x: (x["ts"], x["record_id"]))["record_id"] if earlier else None
    return out


def test_resolution_on_a_hot_url(spark):
    """Thousands of records of one URL over many slices, ties, nulls and repeats."""
    import random

    rng = random.Random(3)
    rows = []
    for i in range(1500):
        url = rng.choice(["https://hot.org/x", "http://www.hot.org/x/#a", "https://hot.org/x?utm_a=1"]) if rng.random() < 0.7 else rng.choice([f"https://c{i % 40}.org/", None, "bad"])
        kind = rng.choice(["response", "revisit", "revisit", "metadata", None])
        rows.append((i, kind, url, rng.choice([None, *(rng.randrange(0, 40) * 30_000 for _ in range(20))]), None, None))
    df = spark.createDataFrame(rows, "record_id bigint, record_type string, url string, ts bigint, digest string, headers map<string,string>")
    canon = {r.url: r.c for r in df.select("url", warc.canonical_url(F.col("url")).alias("c")).distinct().collect()}
    expected = brute_resolve([dict(zip(df.columns, r, strict=True)) for r in rows], canon)
    got = {r.record_id: r for r in warc.resolve(df).collect()}
    assert {k: v.refers_to for k, v in got.items()} == expected
    assert {v.status for v in got.values()} == {"unchecked", "no_url", "no_time", "no_earlier_response"}
    assert warc.resolve(df.limit(0)).collect() == []


def test_validators_and_headers(spark):
    full = {"ETag": '"a"', "Content-Type": "text/html", "Content-Length": "10", "Cache-Control": "x", "Date": "1"}
    rows = [
        (1, "response", "https://a.org/", 1, "d1", full),
        (2, "revisit", "https://a.org/", 2, None, {"etag": 'W/"a"', "content-length": "0", "DATE": "2", "Connection": "close", "New": "n"}),
        (3, "revisit", "https://a.org/", 3, "d2", {"etag": '"a"'}),
        (4, "revisit", "https://a.org/", 3, None, {"etag": '"b"'}),
        (5, "revisit", "https://a.org/", 4, "d1", None),
    ]
    df = spark.createDataFrame(rows, "record_id bigint, record_type string, url string, ts bigint, digest string, headers map<string,string>")
    got = {r.record_id: r for r in warc.resolve(df).collect()}
    assert {k: v.status for k, v in got.items()} == {2: "resolved", 3: "validator_mismatch", 4: "validator_mismatch", 5: "resolved"}
    assert got[2].headers == {"etag": 'W/"a"', "content-type": "text/html", "content-length": "10", "cache-control": "x", "date": "2", "new": "n"}
    assert got[5].digest == "d1" and got[3].headers is None
