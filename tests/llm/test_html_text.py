from __future__ import annotations

import math
import random
import time

import pytest

from letterloom.llm.html_text import content_roots, extract_pages, main_text, measure, parse

STORY = "".join(f"<p>Paragraph {k} of the story, long enough to be dense text about something.</p>" for k in range(6))
PLAIN = "\n\n".join(f"Paragraph {k} of the story, long enough to be dense text about something." for k in range(6))


def test_article_among_the_rest():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
        f"<article><h1>Head &amp; line</h1>{STORY}<form><input></form><aside>See also</aside></article>"
        "<div id=comments><p>First! I do not agree with this article at all, not in the least.</p></div>"
        "<div class=ad>Buy now</div><footer>&copy; Site</footer></body></html>"
    )
    assert main_text(page) == f"Head & line\n\n{PLAIN}"


def test_page_without_names():
    menu = "".join(f"<li><a href=/{k}>Entry {k}</a></li>" for k in range(12))
    page = f"<body><div><ul>{menu}</ul></div><div><div>{STORY}</div><div><p>One more paragraph that ends the story for good here.</p></div></div><div><a href=/x>Imprint</a> <a href=/y>Terms</a></div></body>"
    assert main_text(page) == f"{PLAIN}\n\nOne more paragraph that ends the story for good here."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p></p>", ""), ("just text", "just text"), ("a < b &lt; c &#233; &#x00000e9; &#00000233; &nosuch;", "a < b < c é é é &nosuch;"),
    ("<article><p><b>One<br><p>Two\n  words</article>", "One\n\nTwo words"),
    ("<article><p>Kept<script>alert(1)</article>", "Kept"), ("<article><p>Kept<!-- open comment", "Kept"),
    ("<article><p>Kept<a title='x>y'>link</a> end", "Keptlink end"), ("<article><ul><li>One<li>Two</ul></article>", "One\n\nTwo"),
    ("<article><table><tr><td>A<td>B<tr><td>C</table></article>", "A\n\nB\n\nC"), ("<article>x</b></i>y</article>", "xy"),
    ("<main><p>In <em>main</em>, whole.</p></main><p>Out</p>", "In main, whole."),
])
def test_odd_markup(page, text):
    assert main_text(page) == text


def test_density_by_hand():
    root = parse("<body><div><p>aaaa bbbb</p><p>cccc</p></div><div><a>dddd</a></div></body>")
    nodes = {(n.tag, n.chars): n for n in measure(root)}
    assert nodes["p", 8].density > nodes["p", 4].density > nodes["a", 4].density >= 0
    assert nodes["div", 12].total == pytest.approx(nodes["p", 8].density + nodes["p", 4].density)
    assert nodes["div", 12] in content_roots(root)


@pytest.mark.parametrize("part", ["<div>", "<p>", "<", "<a b", "</x>", "<!--", "&", "&#1", "<a x='", "<script>", "<li>", "a "])
def test_hostile_pages_take_linear_time(part):
    start = time.process_time()
    main_text(part * 20_000)
    assert time.process_time() - start < 10


def test_pages(spark):
    rows = [(1, "u", f"<article>{STORY}</article>", "c"), (1, "u", f"<article>{STORY}</article>", "c"), (2, None, None, "c"), (None, "", "", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_pages(pages).collect()), key=repr)
    assert got == sorted([(1, "u", PLAIN, len(PLAIN))] * 2 + [(2, None, "", 0), (None, "", "", 0)], key=repr)
    assert extract_pages(pages.where("false")).collect() == []


def test_an_article_keeps_its_lists_of_links_and_its_other_parts():
    sources = "<ul>" + "".join(f"<li><a href=/{k}>Source number {k}</a></li>" for k in range(3)) + "</ul>"
    second = "<p>The second part of the story goes on for about as long as the first one did.</p>" * 4
    page = f"<body><div><article>{STORY}{sources}</article><article>{second}</article></div></body>"
    text = main_text(page)
    assert text.startswith(f"{PLAIN}\n\nSource number 0\n\nSource number 1\n\nSource number 2\n\nThe second part")
    assert text.count("The second part") == 4


def test_one_wrapper_with_unnamed_side_blocks():
    sidebar = "<div><div><span>Hot</span> <span>now</span> <a href=/1>one</a> <a href=/2>two</a> <b>three</b></div></div>"
    notice = "<div><p><b>Note</b> <i>well</i>: <a href=/t>terms</a></p></div>"
    page = f"<body><div>{notice}<h1>Title</h1><div>{STORY}</div>{sidebar}<div><p>One more paragraph that ends the story for good here.</p></div></div></body>"
    want = f"Title\n\n{PLAIN}\n\nOne more paragraph that ends the story for good here."
    assert main_text(page) == want
    assert main_text(page.replace("<body>", "<body>stray ")) == f"stray\n\n{want}"
    assert main_text(page.replace("<div>", "<main>", 1).replace("</div></body>", "</main></body>")) == want


WRAPPERS = [
    '<div class="page with-sidebar">{}</div>', '<div class="layout sidebar-right">{}</div>', '<div class="post no-comments">{}</div>',
    '<div class="article-body ad-free">{}</div>', '<section id="hide-banner">{}</section>', '<div class="widget"><main>{}</main></div>',
    '<div class="has-menu"><div class="content menu-open">{}</div></div>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div>{}</div>"])
def test_names_of_wrappers_lose_no_article(wrapper, inner):
    side = '<div class="sidebar"><p>Other things to read here today</p></div><div class="comment-list"><p>A reader says so</p></div>'
    page = "<body>" + wrapper.format(inner.format(STORY) + side) + "</body>"
    assert main_text(page) == PLAIN


def test_comments_in_articles_of_their_own_are_no_article():
    comments = '<section class="comments">' + '<article class="comment"><p>I think otherwise, and at some length too.</p></article>' * 3 + "</section>"
    assert main_text(f"<body><main><article>{STORY}{comments}</article></main></body>") == PLAIN
    assert main_text(f"<body><article>{STORY}</article>{comments}</body>") == PLAIN


def test_texts_of_formulas_objects_and_samples_stay():
    page = "<article><p>Energy is <math><mi>E</mi></math> here.</p><object>no player</object><map><p>in a map</p></map><xmp>a < b</xmp></article>"
    text = main_text(f"<body>{page}</body>")
    for part in ("Energy is E here.", "no player", "in a map", "a < b"):
        assert part in text


def by_definition(node):
    """(chars, linked chars, tags, link tags) of a node, counted anew by walking all below it."""
    chars = linked = tags = links = 0
    stack = [(node, node.tag == "a")]
    while stack:
        item, in_link = stack.pop()
        for part in item.parts:
            if isinstance(part, str):
                size = len("".join(part.split()))
                chars, linked = chars + size, linked + size * in_link
            elif not part.side:
                tags, links = tags + 1, links + (part.tag == "a")
                stack.append((part, in_link or part.tag == "a"))
    return chars, linked, tags, links


@pytest.mark.parametrize("seed", range(5))
def test_densities_by_definition(seed):
    rng = random.Random(seed)
    page = "".join(rng.choice(["<div>", "</div>", "<p>", "<a>", "</a>", "<b>", "</b>", "words of text ", "<br>", '<i class="ad">x</i>']) for _ in range(300))
    root = parse(f"<body>{page}</body>")
    nodes = measure(root)
    whole_chars, whole_linked, *_ = by_definition(root)

    def density(node):
        c, lc, t, lt = by_definition(node)
        if not c:
            return 0.0
        t, lt = max(1, t), max(1, lt)
        base = math.log(c / max(1, c - lc) * lc + whole_linked / max(1, whole_chars) * c + math.e)
        return c / t * max(0.0, math.log(c / max(1, lc) * t / lt)) / base

    for node in nodes:
        assert node.density == pytest.approx(density(node))
        below = sum(density(p) for p in node.parts if not isinstance(p, str) and not p.side)
        assert node.total == pytest.approx(below or density(node))
