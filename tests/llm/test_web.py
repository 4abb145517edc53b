"""Pages and URLs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samedays.llm import pages, urls

LONG = "This is a sentence of the article, with commas, and enough words to be read as one, so it scores."

PAGES = {
    "": "",
    "plain text only": "plain text only",
    f"<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{LONG}<br>More &amp; more<p>Last.</article><footer>no</footer>": f"Title {LONG} More & more Last.",
    f"<body><div class='sidebar'>side</div><div id=content><h2>Head</h2><p>{LONG}</p><p>Short.</p><div class='comments'><p>{LONG} {LONG}</p></div></div></body>": f"Head {LONG} Short.",
    f"<script>var a='<p>{LONG}</p>'</script><style>p{{}}</style><!-- <p>no</p> --><main><p>A<b>B</b>C  \n D</p></main>": "ABC D",
    f"<div class=cookie-notice>We use cookies, {LONG}</div><article><header>by me</header><p>{LONG}</p><form>mail <input></form><aside>x</aside></article>": LONG,
    f"<article><p>{LONG}</p><ul><li><a href=1>one link</a><li><a href=2>two links</a></ul><ul><li>kept item<li>other item</ul></article>": f"{LONG} one link two links kept item other item",
    "<article><p>x &lt; y &copy; &#233; 1 < 2</p></article>": "x < y © é 1 < 2",
    f"<div><p>{LONG}</p></div><div class='ad'>buy</div>": LONG,
    "<nav>only menus</nav>": "",
    "<article><p>unfinished <b": "unfinished",
}


#: What an article keeps although it looks like something else, and inline parts that go whole.
KEPT = {
    f"<article><p>{LONG}</p><h2>Sources</h2><ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul></article>": f"{LONG} Sources First source Second source",
    f"<article><p>{LONG}</p><table><tr><td><a href=1>Ann</a><td>12<tr><td><a href=2>Bob</a><td>13</table></article>": f"{LONG} Ann 12 Bob 13",
    f"<ul><li><a href=1>Menu</a><li><a href=2>Other</a></ul><div><p>{LONG}</p></div>": LONG,
    f"<article><p>{LONG}</p><div class='market-share'><p>Shares rose.</p></div><section id='legal-history'>Law.</section></article>": f"{LONG} Shares rose. Law.",
    f"<article><p>{LONG}</p><div class='share-buttons'>Tweet</div><div class='box legal-notice'>(c)</div><div id=site-footer>x</div></article>": LONG,
    f"<main><article><p>{LONG}</p></article><article><p>Second. {LONG}</p></article><nav>x</nav></main>": f"{LONG} Second. {LONG}",
    f"<main><article><p>{LONG}</p></article><article><a href=1>Read this, and this, and more of this too</a></article></main>": LONG,
    f"<article><p>One <span class=ad><b>Buy now</b></span>two. {LONG}</p><p>x<span class=ad><span>in</span> out</span>y</p></article>": f"One two. {LONG} xy",
    f"<article><p>Open <span class=ad>gone<p>{LONG}</article>": f"Open {LONG}",
}


@pytest.mark.parametrize("page", list(KEPT))
def test_an_article_is_kept_whole(page):
    assert pages.main_text(page) == KEPT[page]


def brute_page(rng) -> tuple[str, str]:
    """A page made of known parts, and its article's text."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(12, 30))) + ", and so on."
    noise = [
        "<nav><ul>{}</ul></nav>".format("".join(f"<li><a href=x>{word()}</a>" for _ in range(6))),
        f"<div class='sidebar widget'><p>{sentence()}</p></div>",
        f"<footer>{sentence()}</footer>",
        f"<form>{word()}<input></form>",
        f"<script>var x = '<p>{sentence()}</p>';</script>",
        f"<div id=cookie-banner>{sentence()}</div>",
        f"<section class=comments><p>{sentence()}</p></section>",
        f"<p hidden>{sentence()}</p>",
    ]
    blocks, texts = [], []
    for _ in range(rng.randint(2, 7)):
        text = sentence()
        tag = rng.choice(["p", "p", "p", "blockquote", "h2"])
        shown = text if rng.random() < 0.6 else text.replace(" ", " <b>", 1).replace(",", "</b>,", 1)
        if rng.random() < 0.3:
            shown = shown.replace(", and", ",<span class=ad><i>buy</i> now</span> and", 1)
        blocks.append(f"<{tag}>{shown}</{tag}>")
        texts.append(text)
        if rng.random() < 0.3:
            blocks.append(rng.choice(noise[1:]))
        if rng.random() < 0.3:
            listed = [word() for _ in range(3)]
            blocks.append("<ul>" + "".join(f"<li><a href=x>{w}</a></li>" for w in listed) + "</ul>")
            texts += listed
    frame = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<div class=page><article class=post>{}</article></div>"])
    around = [rng.choice(noise) for _ in range(4)]
    return "<html><body>" + "".join(around[:2]) + frame.format("".join(blocks)) + "".join(around[2:]) + "</body></html>", " ".join(texts)


def test_generated_pages():
    import random

    rng = random.Random(17)
    for _ in range(400):
        page, text = brute_page(rng)
        assert pages.main_text(page) == text, page


def test_unclosed_inline_adverts_take_linear_time():
    from time import perf_counter

    for page in ("<article>" + "<span class=ad>" * 50_000 + "x", "<article><p>" + "<span class=ad>a</span>" * 50_000, "<span class=ad><i>" * 20_000 + "</span>" * 20_000):
        started = perf_counter()
        pages.main_text(page)
        assert perf_counter() - started < 3


@pytest.mark.parametrize("page", list(PAGES))
def test_main_text(page):
    assert pages.main_text(page) == PAGES[page]


def test_extract(spark):
    rows = [(1, "u", "<article><p>éé</p></article>", 5), (None, None, None, 6), (1, "u", "<article><p>éé</p></article>", 5), (2, None, "", 7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    made = sorted(map(tuple, pages.extract(frame).collect()), key=str)
    assert made == sorted([(1, "u", "éé", 2), (None, None, "", 0), (1, "u", "éé", 2), (2, None, "", 0)], key=str)
    assert pages.extract(frame.limit(0)).count() == 0


def test_long_and_deep_pages():
    assert pages.main_text("<article>" + "<p>word, word</p>" * 50_000).count("word") == 100_000
    assert pages.main_text("<div>" * 20_000 + "deep text" + "</div>" * 20_000) == "deep text"
    assert pages.main_text('<a b="' * 5_000 + "x") is not None


URLS = {
    "https://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
    "http://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "http://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://x.com": ("x.com", "", None, "allow"),
    "http://x.com/": ("x.com", "/", "com/", "allow"),
    "http://telecom/": ("telecom", "/", None, "allow"),
    "http://a.net/es/1://b": ("a.net", "/es/1://b", "net/es/", "block"),
    "http://a.net?u=/fr/": ("a.net", "", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://spam.bad.org/1": ("spam.bad.org", "/1", None, "block"),
    "http://good.org/1": ("good.org", "/1", None, "allow"),
}


def test_urls(spark):
    outcomes = [("spam.bad.org", 0)] * 60 + [("spam.bad.org", 1)] * 2 + [("good.org", 1)] * 60 + [("good.org", 0)] * 5 + [("a.net", None), (None, 1)]
    labels = spark.createDataFrame([(h, g, 1) for h, g in outcomes], "host string, good int, rate int")
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    made = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(frame, labels).collect()}
    assert made == dict(enumerate(URLS.values()))
    unlabelled = {r.page_id: r.verdict for r in urls.judge_urls(frame, labels.limit(0)).collect()}
    assert unlabelled == {i: "allow" if v[2] is None else v[3] for i, v in enumerate(URLS.values())}
    assert urls.judge_urls(frame.limit(0), labels).count() == 0


def test_shrinkage_pulls_small_hosts_to_their_domain(spark):
    outcomes = [(f"h{i}.one.org", int(i % 10 > 0)) for i in range(200)] + [("bad.one.org", 0)] + [(f"h{i}.two.org", int(i % 4 == 0)) for i in range(200)]
    levels = urls.host_reputation(spark.createDataFrame(outcomes, "host string, good int"))
    rate = {r.host: r.rate for r in levels["host"].collect()}
    domain = {r.domain: r.rate for r in levels["domain"].collect()}
    assert 0.8 < domain["one.org"] < 0.95 and 0.15 < domain["two.org"] < 0.35
    assert 0 < rate["bad.one.org"] < domain["one.org"]
    assert rate["h1.one.org"] > domain["one.org"] > rate["h0.one.org"]
    assert levels["all"].select(F.col("rate").between(0, 1)).first()[0]


def test_an_unlabelled_host_is_judged_by_its_nearest_labelled_level(spark):
    outcomes = [(f"h{i}.bad.org", 0) for i in range(40) for _ in range(3)] + [(f"h{i}.good.org", 1) for i in range(40) for _ in range(3)]
    outcomes += [(f"www.shop{i}.co.uk", 0) for i in range(40) for _ in range(3)] + [(f"www.site{i}.fr", 1) for i in range(40)]
    labels = spark.createDataFrame(outcomes, "host string, good int")
    wanted = {
        "http://new.bad.org/x": "block",
        "http://a.b.bad.org/x": "block",
        "http://bad.org/": "block",
        "http://new.good.org/x": "allow",
        "http://fresh.co.uk/": "block",
        "http://www.fresh.fr/": "allow",
        "http://other.uk/": "allow",
        "http://h1.bad.org/": "block",
    }
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(wanted)], "page_id long, url string")
    made = {r.page_id: r for r in urls.judge_urls(frame, labels).collect()}
    assert [made[i].verdict for i in range(len(wanted))] == list(wanted.values())
    assert made[0].good_rate < 0.2 < 0.8 < made[3].good_rate
    # without the table of suffixes the two-label one is a domain like any other
    plain = {r.page_id: r for r in urls.judge_urls(frame, labels, suffixes=()).collect()}
    assert plain[4].verdict == "block" and plain[6].verdict == "block"


def test_suffixes_and_registered_domains(spark):
    names = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "b.co.uk": ("co.uk", "b.co.uk"), "x.y.com": ("com", "y.com"), "com": ("com", "com"), "": ("", "")}
    frame = spark.createDataFrame([(n,) for n in names], "host string")
    host = F.col("host")
    rows = frame.select("host", urls.suffix_of(host).alias("s"), urls.registered_domain(host).alias("d")).collect()
    assert {r.host: (r.s, r.d) for r in rows} == names
