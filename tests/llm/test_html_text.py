import random
from html import escape

import awkward
import pytest

from tillroll.llm import html_text as h

PAGE = "page_id long, url string, html string"


def main_of(rng, n=4):
    return [awkward.words(rng, rng.randrange(8, 40)) + rng.choice(["", " é & <b>", " 100 %"]) for _ in range(n)]


def shop(rng, main):
    p = "".join(f"<p>{escape(x)}</p>" for x in main)
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header class=top><h1>Site</h1></header><nav><ul><li><a href='/'>home</a></li></ul></nav><!-- <p>no</p> -->"
            f"<div class='cookie-notice'>We use cookies</div><main>{p}</main><aside>side</aside><form><p>mail</p><input></form>"
            f"<div id='comments'><p>{awkward.words(rng, 60)}</p></div><footer>&copy; x</footer></body></html>")


def blog(rng, main):
    p = "<p>".join(f"<b>{escape(x)}<br>" for x in main)
    return (f"<html><body><div class='ad'>Buy this now</div><div class='post-{rng.randrange(999)} content'><p>{p}</div>"
            f"<div class='sidebar'><p>{awkward.words(rng, 80)}</p></div><noscript>enable</noscript>")


def plain(rng, main):
    return f"<table class=a{rng.randrange(9)}><tr><td class=menu><a href=/>x</a></td><td>" + "".join(
        f"<DIV>{escape(x)}\n  </DIV>" for x in main) + "</td></tr></table>"


def expected(main):
    return "\n".join(" ".join(x.split()) for x in main)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(60):
        make = rng.choice([shop, shop, blog, plain])
        main = main_of(rng)
        rows.append((k, f"https://www.{make.__name__}.example.org:80/{k}?q=1", make(rng, main)))
        want[k] = expected(main)
    rows += [(100, None, None), (101, "", ""), (102, "not a url", "just text\n here &amp; there"), (None, None, "<p>x"),
             (104, "http://a.b/", "<p>unclosed <a href='x>y"), (105, "http://a.b/", "<" * 3000 + "a" * 3000),
             (106, "http://a.b/", "<div>" * 3000 + "deep" + "</div>" * 10), (107, "http://a.b/", '<p a="' * 2000)]
    want |= {100: "", 101: "", 102: "just text here & there", None: "x", 106: "deep"}
    return rows + [rows[0], rows[0]], want


def test_main_text_of_each_template(spark, pages):
    rows, want = pages
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "'clash' as host", "1 as paths", "2 as text").repartition(3)
    got = h.main_texts(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id in want:
            assert r.text == want[r.page_id], r.page_id
    assert {r.page_id: r.url for r in got}[5] == dict((a, b) for a, b, _ in rows)[5]


def test_the_hosts_vote_decides(spark):
    rng = random.Random(6)
    article = lambda n: f"<article><p>{awkward.words(rng, n)}</p></article>"
    other = f"<div class='zone7'><p>{awkward.words(rng, 90)}</p></div>"
    rows = [(k, "http://h.org/x", f"<body>{article(60)}<div class='zone{k}'><p>short</p></div></body>") for k in range(8)]
    rows.append((8, "http://H.org/y", f"<body><article><p>the main text</p></article>{other}</body>"))
    df = spark.createDataFrame(rows, PAGE)
    assert h.chosen_paths(df).where(h.F.col("host") == "h.org").select("path").distinct().collect() == [("/body/article",)]
    assert {r.page_id: r.text for r in h.main_texts(df).collect()}[8] == "the main text"
    alone = spark.createDataFrame(rows[8:], PAGE)
    assert "the main text" != h.main_texts(alone).first().text


def test_whole_small_table_has_the_articles(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/pages.parquet")
    for r in h.main_texts(df).join(df.select("page_id", "html"), "page_id").collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        inner = h.unescape(h.re.sub(r"<[^>]*>", "", h.re.sub(r"<(/?p|/?h1|li|/?ul)\b[^>]*>", "\n", inner)))
        assert r.text == "\n".join(filter(None, (" ".join(x.split()) for x in inner.split("\n"))))


def test_empty_table(spark):
    assert h.main_texts(spark.createDataFrame([], PAGE)).count() == 0


#: Class patterns of real pages around main text, all of which hold a word that also names boilerplate.
AROUND = """<main class='has-sidebar'>|<div class='content with-sidebar'>|<div id='page-search-results'>|<article class='post comments-open'>
    |<div class='no-sidebar'>|<div class='content-sidebar-wrap'>|<div id=widget-area-main-text>|<main class='page-header-fixed'>
    |<div class='post-share-enabled hentry'>|<section class='search-results'>|<div class='layout-nav-left'>|<article class='ad-free'>
    |<div id='story-with-related'>|<div class='social-history'>|<form id=aspnetForm><div>|<div class='header-offset'><main>
    |<div class='menu-open content'>|<div class='page-wrapper nav-pinned'>|<div class='modal-is-closed'>|<div class='topbar-visible'>
    |<div class='navigation'><main>|<div class='cookies-accepted site'>|<div class='newsletter-archive-issue'>|<div class='login-required-no'>"""
INSIDE = ["share-price", "social-history", "related-work", "nav-spacer entry-content", "reply-to-critics", "ad-hoc-query", "search-engine"]
OUTSIDE = ["ad", "cookie-notice", "sidebar", "site-header", "footer-widgets widget", "comment-section", "related-posts", "share-buttons",
           "main-nav", "sidebar left", "newsletter-signup", "ad-slot-3", "post-comments"]


def test_names_alone_drop_no_main_text(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for k, around in enumerate(x.strip() for x in AROUND.split("|")):
        main = main_of(rng, 5)
        p = "".join(f"<p>{escape(x)}</p>" for x in main)
        box = f"<div class='{OUTSIDE[k % len(OUTSIDE)]}'><p>Some other words.</p></div>"
        rows.append((k, f"http://site{k}.org/", f"<html><body>{box}{around}{p}</body></html>"))
        want[k] = expected(main)
    for k, name in enumerate(INSIDE, 100):
        main = main_of(rng, 3)
        rows.append((k, f"http://site{k}.org/", "<body><article>" + "".join(
            f"<div class='{name}'><p>{escape(x)}</p></div>" for x in main) + "<p>and an end</p></article></body>"))
        want[k] = expected(main) + "\nand an end"
    for k, name in enumerate(OUTSIDE, 200):
        rows.append((k, f"http://site{k}.org/", f"<body><div class='{name}'><p>{'x ' * 40}</p></div><article><p>{'the text ' * 30}</p>"
                                                f"<div id='{name}'>inner</div><p>its end</p></article></body>"))
        want[k] = ("the text " * 30).strip() + "\nits end"
    got = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(rows, PAGE)).collect()}
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def brute(rows):
    """Every page's text from all votes of its host, in plain Python."""
    host = lambda u: h.re.match(r"[a-z]+://([^/:]*)", u or "") and h.re.match(r"[a-z]+://([^/:]*)", u)[1].lower() or ""
    total = {}
    for _, url, html in rows:
        for path, vote, _ in h.paths(html):
            votes, n = total.get((host(url), path), (0, 0))
            total[host(url), path] = votes + vote, n + 1
    out = []
    for k, url, html in rows:
        ranked = sorted((-(votes / (n + 1)) * s ** 0.5, p) for p, _, s in h.paths(html)
                        for votes, n in [total[host(url), p]] if votes)
        out.append((k, h.extract(html, ranked[0][1] if ranked else None)))
    return sorted(out, key=repr)


def test_every_template_of_a_host_keeps_its_votes_by_either_join(spark, pages, monkeypatch):
    rng = random.Random(13)
    rows = list(pages[0])
    for k in range(60):  # twenty templates on one host, each with a longer box beside the text on some pages
        box = f"<div class='zone{'abcde'[rng.randrange(5)]}'><p>{awkward.words(rng, rng.choice([5, 90]))}</p></div>"
        rows.append((300 + k, "http://many.org/", f"<body>{box}<div class='kind-{chr(97 + k % 20)}'><p>{awkward.words(rng, 60)}</p></div>"))
    rows.append((999, "http://long.org/", "<body><article>" + "<p>a paragraph of it</p>" * 60_000 + "</article></body>"))
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 as path", "2 as size", "3 as page", "4 as salt")
    want = brute(rows)
    assert len(dict(want)[999]) == 60_000 * 18 - 1
    for limit in (h.BROADCAST_BYTES, -1):
        monkeypatch.setattr(h, "BROADCAST_BYTES", limit)
        assert sorted(((r.page_id, r.text) for r in h.main_texts(df).collect()), key=repr) == want


def test_a_short_note_does_not_win_by_rank_alone(spark):
    rows = [(k, "http://h.org/", f"<body><div class=a><p>{'long words ' * 20}</p></div></body>") for k in range(3)]
    rows += [(k, "http://h.org/", f"<body><div class=b><p>{'other words ' * 30}</p></div></body>") for k in (3, 4)]
    rows.append((5, "http://h.org/", f"<body><div class=a>short note</div><div class=b><p>{'the article ' * 30}</p></div></body>"))
    got = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[5] == ("the article " * 30).strip() and got[0] == ("long words " * 20).strip()
