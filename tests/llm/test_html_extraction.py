import html as entities
import math
import random
import re
import time
from collections import Counter

import pytest

from anchorline.llm import html_extraction
from anchorline.llm.html_extraction import CHUNK, main_text
from anchorline.llm.queries import QUERIES
from conftest import SMALL

PARAGRAPH = "A paragraph of an article with enough words in it to count as content."


def test_driver_pages_give_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in QUERIES["op9_html_extraction"](spark, SMALL).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article)
        lines = [entities.unescape(re.sub(r"<[^>]+>", " ", x)) for x in parts]
        wanted = "\n".join(x for x in (" ".join(y.split()) for y in lines) if x)
        assert r.text == wanted and r.n_chars == len(wanted)


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233;&nbsp;c  \n d</p>", "a <b> &amp; éé c d"),
        (f"<article><h1>T</h1><p>{PARAGRAPH}<p>Short.</article>", f"T\n{PARAGRAPH}\nShort."),
        (f"<nav><a>Home</a></nav><main><p>{PARAGRAPH}</p></main><footer>f</footer>", PARAGRAPH),
        (f"<article><p>{PARAGRAPH}</p><div class='comments'><article><p>{PARAGRAPH}</p></article>"
         "</div></article>", PARAGRAPH),
        (f"<article><div class='advert'>{PARAGRAPH}</div><p>x<b>y</b> z</p></article>", "xy z"),
        (f"<article><form><p>{PARAGRAPH}</p></form><p>x</p><aside>y</aside></article>", "x"),
        (f"<div id='cookie-notice'>{PARAGRAPH}</div><article><p>x</p></article>", "x"),
        (f"<div class='page with-sidebar'><article><p>{PARAGRAPH}</p></article></div>", PARAGRAPH),
        (f"<article><p>{PARAGRAPH}</p><p hidden>no</p><p style='display: none'>no</p></article>", PARAGRAPH),
        ("<article><script>var t='</p>';</script><style>p{}</style><p>x</p><!-- y --></article>", "x"),
        (f"<div id='menu'><a href=x>Home</a><a>Go</a></div><div><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
         "<p>Tiny.</p></div></div>", f"{PARAGRAPH}\n{PARAGRAPH}\nTiny."),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\ntwo\na\nb"),
        ("<article><p>a<br>b</p></article>", "a b"),
        ("<![if x]><article><p>a</p><![CDATA[b]]></article>", "a"),
        ("<p>never closed <b>bold", "never closed bold"),
        ("</p></div></article>", ""),
        # Names of what is, or holds, an article; forms around it; siblings.
        (f"<article class='post category-social'><p>{PARAGRAPH}</p><p>x</p></article>", f"{PARAGRAPH}\nx"),
        (f"<article class='hentry comments-open'><p>{PARAGRAPH}</p></article>", PARAGRAPH),
        (f"<main id='search-page'><p>{PARAGRAPH}</p><p>x</p></main>", f"{PARAGRAPH}\nx"),
        (f"<form id='aspnetForm'><div class='social'><article><p>{PARAGRAPH}</p></article></div></form>", PARAGRAPH),
        (f"<form id='aspnetForm'><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></form>", f"{PARAGRAPH}\n{PARAGRAPH}"),
        (f"<article><p>{PARAGRAPH}</p></article><nav>n</nav><article><p>Second.</p></article>", f"{PARAGRAPH}\nSecond."),
        (f"<article><section id='notice-of-award'><p>{PARAGRAPH}</p></section></article>", PARAGRAPH),
        (f"<article><p>{PARAGRAPH}</p></article><div id='comments'><article class='comment'><p>{PARAGRAPH}</p>"
         "</article></div>", PARAGRAPH),
        (f"<article><p>{PARAGRAPH}</p></article><article class='teaser'><p>{PARAGRAPH}</p></article>", PARAGRAPH),
        (f"<div class='page-header'><article><p>{PARAGRAPH}</p></article></div>", PARAGRAPH),
        (f"<main><h1>T</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><article>q</article></main>",
         f"T\n{PARAGRAPH}\n{PARAGRAPH}\nq"),
        (f"<article><div class='share-tools'><a>Send</a></div><p>{PARAGRAPH}</p><div class='cookie-notice'>"
         f"{PARAGRAPH}</div></article>", PARAGRAPH),
        # A run of links in an article is a menu, one line of links is not.
        (f"<article><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul>"
         "</article>", f"{PARAGRAPH}\n{PARAGRAPH}"),
        (f"<article><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p><a>The source</a></p></article>",
         f"{PARAGRAPH}\n{PARAGRAPH}\nThe source"),
    ],
)
def test_pages(page, wanted):
    assert main_text(page) == wanted


def test_tags_and_references_may_cross_chunks():
    body = "<p>" + "x&amp;y " * CHUNK + "</p>"
    for shift in range(3):
        page = "<article>" + " " * shift + body + "</article>"
        assert main_text(page) == " ".join(["x&y"] * CHUNK)


def content_by_hand(lines, links):
    """Which lines the smoothed ratios of characters to tags make content; those of links only
    if their own ratio does too."""
    ratio = [len(text) / max(tags, 1) for text, tags in lines]
    weight = {d: math.exp(-d * d / 2) for d in range(-2, 3)}
    total = sum(weight.values())
    smooth = [
        sum(weight[j - i] / total * ratio[j] for j in range(max(i - 2, 0), min(i + 3, len(lines))))
        for i in range(len(lines))
    ]
    mean = sum(smooth) / len(smooth)
    limit = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    return [x >= limit and (not a or y >= limit) for x, y, a in zip(smooth, ratio, links, strict=True)]


@pytest.mark.parametrize("around", ["div", "article"])
def test_ratios_decide_about_linked_lines(around):
    """Pages of plain and linked lines: what stays is what the ratios spelt out say."""
    draw = random.Random(3)
    for _ in range(60):
        # (text, whether it is a link): every line is <p>..</p> or <p><a>..</a></p>.
        body = [("word " * draw.choice([1, 2, 30, 60])).strip() + f" {i}" for i in range(draw.randint(8, 25))]
        links = [draw.random() < 0.5 for _ in body]
        html = "".join(f"<p><a>{t}</a></p>" if a else f"<p>{t}</p>" for t, a in zip(body, links, strict=True))
        tags = [4 if a else 2 for a in links]
        tags[0] += 1  # that of the element around
        content = content_by_hand(list(zip(body, tags, strict=True)), links)
        low = [a and not c for a, c in zip(links, content, strict=True)]
        beside = [any(low[j] for j in (i - 1, i + 1) if 0 <= j < len(low)) for i in range(len(low))]
        wanted = [t for i, t in enumerate(body) if not low[i] or around == "article" and not beside[i]]
        assert main_text(f"<{around}>{html}</{around}>") == "\n".join(wanted)


def test_deep_nesting_is_linear():
    deep = "<div>" * 20_000 + "".join(f"<p>{PARAGRAPH} {i}</p>" for i in range(2_000))
    started = time.perf_counter()
    assert main_text(deep).count("\n") == 1_999
    assert time.perf_counter() - started < 5


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>a</p>"), (2, "v", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extraction.extract(frame.selectExpr("*", "'x' AS text", "1 AS n_chars"))
    assert Counter(map(tuple, got.collect())) == Counter(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", "a", 1), (2, "v", "", 0)]
    )
    assert html_extraction.extract(frame.limit(0)).count() == 0
