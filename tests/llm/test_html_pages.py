"""Odd and broken pages, and pages built from known articles."""

import random
import time

import pytest

from tessera.llm import html


def text(source):
    page = html.Page(source)
    return page.text(page.best()[0]).split("\n")


@pytest.mark.parametrize("source, want", [
    ('<div class="menu">' * 1100 + "x" + "</div>" * 1100 + "<p>A real article text.</p>", ["A real article text."]),
    ("<p title=Bob's>One.</p><p>Two's.</p><p>Three.</p><p>ok</p>", ["One.", "Two's.", "Three.", "ok"]),
    ("<!--><p>Hello there.</p>", ["Hello there."]),
    ("<!---><p>Hello there.</p><!-- no --> <p>More.", ["Hello there.", "More."]),
    ("<p>a < b and c > d</p><p>one <3", ["a < b and c > d", "one <3"]),
    ("<p title='open>One.</p><p>Two.</p>", ["One.", "Two."]),
    ("<p class=x/>One.</p><p data-a=1 hidden>No.</p><p>Two.</p>", ["One.", "Two."]),
    ("<p>one<script>var a = '<p>no</p>';</script> two<style>p{}</STYLE ></p>", ["one two"]),
    ("<p>&lt;b&gt; &amp; &eacute;&#x41;</p>", ["<b> & éA"]),
    ("", [""]), ("<", ["<"]), ("</", ["</"]), ("<p", ["<p"]), ("plain", ["plain"]), ("<p>\x00\ud800</p>", ["\x00\ud800"]),
])
def test_odd_pages(source, want):
    assert text(source) == want


@pytest.mark.parametrize("source, blocks", [
    ("".join(f"<div>text {i} " for i in range(10_000)), 10_000),
    ("".join(f'<div class="c{i % 7} menu">text {i} ' for i in range(10_000)), 9_999),  # the innermost is a menu
    ("<a " * 60_000, 1), ('<a x="' * 30_000 + ">", 1), ("<p title='" * 30_000 + ">end", 1),
    ("<i><div>" + "<b>" * 10_000 + "</i>" * 10_000 + "z", 1), ("<ul>" * 5_000 + "<li>x" * 5_000, 5_000),
    ("<!--" * 50_000, 1), ("<div><p>x</div>" * 10_000, 10_000)])
def test_time_grows_with_the_page(source, blocks):
    start = time.process_time()
    assert len(text(source)) == blocks
    assert time.process_time() - start < 4  # well below a second on a free machine; a square would take minutes


def test_links_are_seen_at_any_depth():
    nested = "<a href=x>" + "<b>" * 6 + "menu entry number one" + "</b>" * 6 + "</a>"
    page = html.Page(f"<div>{nested}</div><div><p>text</p></div><a name=top><div><p>more text</p></div>")
    assert [b.linked > 0 for b in page.all] == [True, False, False]


WORDS = "river stone morning careful 'quoted' half-light &amp; seven façade".split()


@pytest.mark.parametrize("seed", range(12))
def test_articles_between_boilerplate(seed):
    """Pages put together from an article, known by construction, and what belongs to none."""
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    blocks = [(rng.choice(["p", "h2", "li", "blockquote", "pre"]), words(rng.randint(12, 40))) for _ in range(rng.randint(4, 9))]
    title = words(5)
    article = f"<h1 class=title>{title}</h1>" + "".join(
        f"<ul><{t}>{x}</{t}></ul>" if t == "li" else f"<{t} id=b{k}>{x}</{t}>" for k, (t, x) in enumerate(blocks))
    links = "".join(f"<li><a href=/{k}>{words(2)}</a>" for k in range(6))
    holder = rng.choice(['<article>{}</article>', '<main class="post no-sidebar">{}</main>', '<div class="entry-content">{}</div>',
                         '<div id=content><div class="body">{}</div></div>'])
    page = (f"<!doctype html><html><head><title>{words(4)}</title><style>p{{}}</style>"
            f"<body class=home><header><p>{words(3)}</p></header><nav><ul>{links}</ul></nav>"
            f"<div class=page-wrap>{holder.format(article)}<aside><p>{words(8)}</p></aside></div>"
            f"<div class='cookie-notice'>{words(6)}</div><div id=comments><p>{words(10)}</p></div>"
            f"<form><p>{words(3)}</p></form><footer>{words(5)}</footer><script>if (a<b) x('<p>')</script>")
    want = [t.replace("&amp;", "&") for t in [title, *[x for _, x in blocks]]]
    assert text(page) == want


def test_host_of_is_one_for_votes_and_pages(spark):
    rows = [(i, f"http://h.example/{i}", f"<div class=a><p>{'left ' * 30}</p></div><div class=b><p>{'right ' * (5 + 40 * (i == 0))}</p></div>")
            for i in range(5)]
    got = {r["page_id"]: r["text"] for r in html.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith("left") for i in range(1, 5))
