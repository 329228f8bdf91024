import math
import random
import re
import time
from html import unescape

import pytest

from parcela.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="top">Site <a href=x>name</a></header><nav><ul><li><a href=a>Home</a></li></ul></nav>
<div class="cookie-banner">We use cookies</div>{main}<aside>More</aside>
<section id="comments"><article class="comment"><p>Nice and long reader comment that is not the article at all, really.</p></article></section>
<form><p>Subscribe</p><input name=q></form><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize(
    ("main", "text"),
    [
        ("<article><h1>Head</h1><p>One &amp; two.</p><p>Yes.</p></article>", "Head One & two. Yes."),
        ("<article><h1>Head</h1><p><b>Bold line.<br><p>Open <i>inline</i>\n  text</article>", "Head Bold line. Open inline text"),
        ("<main><article><header><h1>H</h1></header><p>Body &lt;tag&gt; &#233;&nbsp;x</p><div class=ad>Buy</div><footer>Share</footer></article></main>", "H Body <tag> é x"),
        ("<div class='post wrap'><h2>Title of it</h2><p>" + "A long paragraph of words. " * 9 + "</p><p>Short.</p><p>" + "Another long paragraph here. " * 9 + "</p></div>", None),
        ("<article></article>", ""),
    ],
)
def test_pages(main, text):
    got = html_text.main_text(PAGE.format(main=main))
    if text is None:
        assert got.startswith("Title of it A long") and " Short. Another" in got and got.endswith("here.") and "cookies" not in got and "comment" not in got
    else:
        assert got == text


def test_short_blocks_stay():
    body = "".join(f"<p>{'Word ' * n}</p>" for n in (40, 1, 1, 1, 60, 1))
    got = html_text.main_text(PAGE.format(main=f"<article>{body}</article>"))
    assert got.split() == ["Word"] * 104


def _blocks(*sizes, tag="p"):
    return "".join(f"<{tag}>{chr(97 + i) * n}</{tag}>" for i, n in enumerate(sizes))


@pytest.mark.parametrize("sizes", [(40, 90, 600, 600, 600, 600, 600, 120, 60), (30, 900, 20), (900, 20, 20), (20, 20, 900)])
@pytest.mark.parametrize("tag", ["p", "section"])
def test_edge_blocks_stay_without_an_article(sizes, tag):
    """Also where one paragraph or section holds most of the text."""
    got = html_text.main_text(PAGE.format(main=f"<div class=post>{_blocks(*sizes, tag=tag)}</div>"))
    assert [len(w) for w in got.split()] == list(sizes)


@pytest.mark.parametrize(
    "main",
    [
        "<article class='post tag-social category-notices comments-open'>{}</article>",
        "<article class='post tag-comments has-sidebar' id=post-7>{}</article>",
        "<article class='widget'>{}</article>",
        "<main><div class='elementor-widget-container'>{}</div></main>",
        "<main><div class='widget social'>{}</div><div class='share-bar'>Share it</div><div class='site-footer'>Foot</div></main>",
        "<div class='widget'><div class='post has-alert'>{}</div></div>",
    ],
)
def test_names_do_not_drop_the_article(main):
    body = f"<h1>Head</h1>{_blocks(80, 200, 30)}<ul class='related-posts'><li>Other</li></ul><div id=post-comments>{_blocks(900, 900)}</div>"
    assert [len(w) for w in html_text.main_text(PAGE.format(main=main.format(body))).split()] == [4, 80, 200, 30]


@pytest.mark.parametrize("html", [None, "", "plain text", "<p", "<!--", "</article></article>", "<article>" * 300, "<p>x</p>" * 5000])
def test_odd_pages(html):
    got = html_text.main_text(html)
    assert got == ("plain text" if html == "plain text" else " ".join(["x"] * 5000) if html and len(html) > 9000 else got)


def test_smoothing_keeps_the_mean_of_a_constant():
    assert html_text.smoothed([3.0] * 5, 1.0) == pytest.approx([3.0] * 5)


def test_table(spark):
    rows = [(1, "u", "<article>é😀</article>", 1), (1, "u", "<article>é😀</article>", 1), (2, None, None, 1), (None, "v", "", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    out = sorted(map(tuple, html_text.extract(df).collect()), key=str)
    assert out == sorted([(1, "u", "é😀", 2), (1, "u", "é😀", 2), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>T</title><body><p>One.<p>Two.", "One. Two."),
        ("<head><title>T</title><p>One.<p>Two.", "One. Two."),
        ("<head>Loose <p>Two.", "Loose Two."),
        ("<article><ul><li class=share>Share<li>Real item</ul></article>", "Real item"),
        ("<article><table><tr><td class=sidebar>side<td>Real cell<tr><td>More</table></article>", "Real cell More"),
        ("<article><dl><dt class=ad>Ad<dd>Real<dt>Term</dl></article>", "Real Term"),
        ("<article><p class=notice-board>Board.</p><p id=comment-on-law>Law.</p><p class=menu-of-the-day>Soup.</p></article>", "Board. Law. Soup."),
        ("<article><h2>A</h2><p>One long text of the first part.</p></article><article><h2>B</h2><p>One long text of the second part.</p></article>", "A One long text of the first part. B One long text of the second part."),
        ("<article><p>Cell <table><tr><td>x</div></td><td>y</td></tr></table> after</article>", "Cell x y after"),
    ],
)
def test_end_tags_may_be_left_out(html, text):
    assert html_text.main_text(html) == text


NAMES = ["related-articles", "siteFooter", "article-comments", "ad-1", "social-media", "shareIcons", "skip-link", "sidebar left-column", "newsletter_signup", "nav-previous"]


@pytest.mark.parametrize("name", NAMES)
def test_names_of_several_words(name):
    page = f"<div class=story-page><div><h1>Head</h1>{_blocks(300, 40, 500)}</div><div class='{name}'>Not of the article</div></div>"
    assert [len(w) for w in html_text.main_text(page).split()] == [4, 300, 40, 500]


LINKS = "".join(f"<div><a href={i}>Go {i}</a></div>" for i in range(6))


def test_ratios_decide(monkeypatch):
    """A menu without a name, and teasers beside the story, go by their ratios alone."""
    story = "".join(f"<p>{'A long sentence of the story. ' * 8}{i}</p>" for i in range(5))
    teasers = "".join(f"<article><b><i><a href=x><b>T{i}</b></a></i></b></article>" for i in range(30))
    for page in (f"<body><div><h1>Head</h1>{LINKS}{story}<p>End.</p></div></body>", f"<body>{LINKS}<article><h1>Head</h1>{story}<p>End.</p></article>{teasers * 9}</body>"):
        got = html_text.main_text(page)
        assert got.startswith("Head A long") and got.endswith("4 End.") and "Go" not in got
        with monkeypatch.context() as m:
            m.setattr(html_text, "ratios", lambda lines, beside: [1.0] * len(lines))
            assert html_text.main_text(page) != got


def test_links_of_an_article_stay():
    """Lists of sources, links to chapters and tables of links are text of the article, unless a name says otherwise."""
    long = "A long paragraph of many words. " * 9
    sources = "".join(f"<li><a href={i}>Paper {i}</a></li>" for i in "123")
    page = f"<article><h1>H</h1><p>{long}</p><h2>Sources</h2><ul>{sources}</ul></article>"
    assert html_text.main_text(PAGE.format(main=page)) == f"H {long}Sources Paper 1 Paper 2 Paper 3"
    page = f"<article><p>{long}</p><p><a href=1>Chapter one</a></p><p><a href=2>Chapter two</a></p><p>{long}</p><table><tr><td><a>x</a><td><a>y</a></table></article>"
    assert html_text.main_text(PAGE.format(main=page)) == f"{long}Chapter one Chapter two {long}x y"
    page = f"<article><p>{long}</p><ul class=related-posts>{sources}</ul><nav>{sources}</nav><ul role=menu>{sources}</ul></article>"
    assert html_text.main_text(PAGE.format(main=page)) == long.strip()


@pytest.mark.parametrize("block", ["p class=alert", "blockquote class='social'", "section class='recommended-reading'", "p class=banner", "p class='copyright'", "div role=alert"])
def test_styles_of_an_article_stay(block):
    tag = block.split()[0]
    page = f"<article><h1>H</h1><p>{'Words of it. ' * 20}</p><{block}>Told aloud.</{tag}><p>End.</p></article>"
    assert html_text.main_text(PAGE.format(main=page)).endswith("it. Told aloud. End.")
    beside = f"<{block}>Told aloud.</{tag}><div><h1>H</h1><p>{'Words of it. ' * 20}</p><p>{'Words of it. ' * 20}</p></div>"
    assert "aloud" not in html_text.main_text(PAGE.format(main=beside))


def test_short_articles_and_long_adverts():
    advert = f"<div class=ad>{'Buy this now and again. ' * 20}</div>"
    assert html_text.main_text(f"<body>{advert}<article><h1>x</h1><p>y</p></article></body>") == "x y"
    assert html_text.main_text(f"<body><article><h1>x</h1>{advert}<p>y</p></article></body>") == "x y"


def _given(sf_dir):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/pages.parquet", columns=["html"]).column("html").to_pylist()


def test_constant_ratios_change_given_pages(sf_dir, monkeypatch):
    """Without ratios the region is no longer that of the article: menus and footers come in."""
    pages = _given(sf_dir)
    found = [html_text.main_text(h) for h in pages]
    monkeypatch.setattr(html_text, "ratios", lambda lines, beside: [1.0] * len(lines))
    changed = [html_text.main_text(h) for h in pages]
    assert sum(a != b for a, b in zip(found, changed, strict=True)) > len(pages) / 4


def _plain_cluster(html, sigma=1.0, part=0.5):
    """(text, ratio, in the cluster) of each line of a page as those given, by cutting its source at block tags."""
    body = re.sub(r"<(script|style|title|!--).*?(</\1>|-->)", lambda m: "<i></i>" if m[1] != "!--" else "", html, flags=re.S)
    lines, tags, beside = [], 0, 0
    for piece in re.split(r"(<[^>]*>)", body):
        if piece.startswith("<"):
            tags += not piece.startswith("<!")
            out = piece.startswith(("<nav", "<footer", "<div class=\"ad\""))
            beside = 1 if out else 0 if piece in ("</nav>", "</footer>", "</div>") else beside
            block = re.match(r"</?(html|head|body|nav|ul|li|div|article|h1|p|br|footer)\b", piece)
            lines.append(None) if block else None
        elif text := " ".join(unescape(piece).split()):
            if lines and lines[-1]:
                lines[-1] = (lines[-1][0] + " " + text, *lines[-1][1:])
            else:
                lines.append((text, tags, beside))
                tags = 0
    lines = [x for x in lines if x]
    ratios = [0 if beside else len(t) / max(1, n) for t, n, beside in lines]
    smooth = []
    for i in range(len(ratios)):
        near = {d: math.exp(-d * d / (2 * sigma**2)) for d in (-2, -1, 0, 1, 2) if 0 <= i + d < len(ratios)}
        smooth.append(sum(w * ratios[i + d] for d, w in near.items()) / sum(near.values()))
    counted = [s for s, r in zip(smooth, ratios, strict=True) if r]
    limit = part * sum(counted) / max(1, len(counted))
    return [(t, r, r > 0 and s >= limit) for (t, _, _), r, s in zip(lines, ratios, smooth, strict=True)]


def test_ratios_smoothing_and_cluster_against_plain_ones(sf_dir):
    some = 0
    for html in _given(sf_dir):
        parser = html_text._Lines()
        parser.feed(html)
        parser.close()
        parser.flush()
        html_text._cluster(parser.lines, html_text._beside(parser.elements, parser.lines, True), 1.0, 0.5)
        expected = _plain_cluster(html)
        assert [x.text for x in parser.lines] == [t for t, _, _ in expected]
        by_tags = [abs(x.ratio - r) < 1e-9 for x, (_, r, _) in zip(parser.lines, expected, strict=True)]
        assert all(by_tags), [(x.text[:30], x.ratio, r) for x, (_, r, _), ok in zip(parser.lines, expected, by_tags, strict=True) if not ok][:3]
        assert [x.content for x in parser.lines] == [c for _, _, c in expected]
        some += any(x.ratio > 0 and not x.content for x in parser.lines)
    assert some > 0


@pytest.mark.parametrize("broken", ["<font><b>x<div>y", "<div>x", "<b>x", "<ul><li>x", "<p><i>x", "<table><tr><td>x", "</div></b>x"])
def test_broken_pages_take_linear_time(broken):
    began = time.perf_counter()
    got = html_text.main_text(broken * (50_000 // broken.count("<")))
    assert time.perf_counter() - began < 4 and "x" in got


def _page(rng):
    """A page built from known parts, and the text of its article."""
    words = [f"w{i}é" for i in range(40)] + ["a&amp;b", "x&lt;y", "&#233;t"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def plain(x):
        return unescape(re.sub(r"<[^>]*>", "", x))

    blocks, texts = [], []
    for i in range(rng.randint(3, 9)):
        tag = "h1" if i == 0 else rng.choice(["p", "p", "p", "h2", "blockquote", "li"])
        inner = prose(rng.choice([2, 8, 30, 90]) if i else 5)
        if rng.random() < 0.4:
            inner = f"{inner} <b>{prose(2)}</b>\n <i class=x>{prose(1)}</i>"
        texts.append(" ".join(plain(inner).split()))
        inner = f"<{tag}>{inner}" + ("" if tag in ("p", "li") and rng.random() < 0.4 else f"</{tag}>")
        blocks.append(f"<ul>{inner}</ul>" if tag == "li" else inner)
        if rng.random() < 0.3:
            blocks.append(rng.choice(["<div class='ad-box'>Buy now</div>", "<aside>Side</aside>", "<script>var a='<p>no</p>'</script>", "<ul class=share-links><li>Tweet<li>Post</ul>", "<!-- no -->", "<form>Mail <input></form>"]))
    outer = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article class='post tag-news'>{}</article></main>", "<div class=content-main><div>{}</div></div>"])
    parts = [
        rng.choice(["<header><a href=/>Site</a></header>", ""]),
        "<nav><ul>" + "".join(f"<li><a href={i}>N{i}</a>" for i in range(5)) + "</ul></nav>",
        rng.choice(["<div class='cookie-notice'>We use cookies</div>", "<div class=ad>" + prose(9) + "</div>", ""]),
        outer.format("".join(blocks)),
        rng.choice(["<section id=comments><article><p>" + prose(60) + "</p></article></section>", "<div id=sidebar>" + prose(5) + "</div>", ""]),
        "<footer>&copy; " + prose(6) + "</footer>",
    ]
    return "<!DOCTYPE html><html><head><title>T</title></head><body>" + "".join(parts), " ".join(t for t in texts if t)


def test_pages_of_known_articles():
    rng = random.Random(5)
    wrong = []
    for _ in range(400):
        html, text = _page(rng)
        if html_text.main_text(html) != text:
            wrong.append((html, text))
    assert not wrong, (len(wrong), wrong[0], html_text.main_text(wrong[0][0]))
