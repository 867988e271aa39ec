import random
import time
from collections import Counter

import pytest

from threadloom.llm import html

LONG = "This is a paragraph of the text that is long enough to be seen as the main text of a page because it has many of the words that a text has in it and goes on for a while so that there is no doubt about it at all, not even for a machine."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<article><h1>T &amp; U</h1><p>a <b>b</b>\n c<br>d<p>e</article>", "T & U\na b c d\ne"),
        (f"<nav><a href=x>Home</a></nav><article><p>x</p></article><footer>f</footer><p>{LONG}</p>", "x"),
        ("<article><p>a</p><div class='ad'>buy</div><aside>s</aside><form><p>f</p></form><script>1<p>2</script><style>p{}</style><p>b</p></article>", "a\nb"),
        ("<article><header><h1>Head</h1></header><p>a</p><section id='comments'><p>c</p></section></article>", "Head\na"),
        ("<header>site</header><main><p>&lt;p&gt; &eacute; &#233; &nbsp;x</p></main>", "<p> é é x"),
        ("<!-- <p>no</p> --><article>loose<p>x<!-- y --></p></article>", "loose\nx"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\ntwo\na\nb"),
        ("<article><p>x < y and a > b</p></article>", "x < y and a > b"),
        (f"<div class='cookie-notice'>{LONG}</div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><ul class='menu'><li><a href='/'>M</a></ul>", f"Head\n{LONG}\nShort.\n{LONG}"),
        (f"<p>{LONG}</p><p>{LONG}</p><p>tail</p><p>tie</p><div>{'<a href=x>link text</a> ' * 20}</div>", f"{LONG}\n{LONG}\ntail"),
        ("<article><p>a<script>var t='</p>';</script>b</p></article>", "a\nb"),
        ("<article><p title='a>b'>x</p><p hidden>y</p><p style='display:none'>z</p></article>", "x"),
        ("<article><p>end", "end"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_second_pass_takes_the_nearest_label():
    good, bad = html.Block(LONG, False, False, 0.0, False), html.Block("menu", True, False, 0.0, False)
    short = html.Block("short", False, False, 0.0, False)
    got = html.classify([good, short, short, short, bad, short, bad, short], False, html.Rules())
    assert got == [True, True, False, False, False, False, False, False]


def test_query_shape(spark):
    rows = [(1, "u", "<article><p>é</p></article>", 5), (None, None, None, 6), (1, "u", "<article><p>é</p></article>", 7), (2, "v", "<main>" + "x" * 300_000 + "</main>", 8)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out.collect()) == [(0, 0), (1, 1), (1, 1), (2, 300_000)]
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_many_open_tags_and_quotes_end():
    assert html.main_text("<article>" + "<p>" * 20_000 + "x") == "x"
    assert html.main_text("<article><p>" + "<a href='x" * 2000 + "</article>") is not None


def test_links_and_cards_are_decided_by_density():
    menu = "<ul><li><a href=x>Menu</a><li><a href=y>Home</a></ul>"
    assert html.main_text(f"<article><p>{LONG}</p>{menu}<p><a href=a>Next story</a> <a href=b>Last story</a></p></article>") == LONG
    assert html.main_text(f"<article><h1>Head</h1><p>{LONG}</p><p><a href=z>Only one link here</a></p></article>") == f"Head\n{LONG}\nOnly one link here"
    cards = "<article><h2>Card</h2></article><article><h2>Other</h2></article>"
    assert f"{LONG}\n{LONG}" in html.main_text(f"{cards}<div id=content><p>{LONG}</p><p>{LONG}</p></div>")
    assert html.main_text(f"{cards}<article><p>{LONG}</p></article><p>{LONG}</p>") == LONG


def test_pages_built_from_known_blocks():
    """Main text between noise of all kinds, with and without an article element."""
    rng = random.Random(8)
    stop = sorted(html.STOP_WORDS)

    def prose(n):
        return " ".join(rng.choice(stop) if rng.random() < 0.5 else f"Word{rng.randrange(999)}" for _ in range(n))

    links = lambda: " ".join(f"<a href=/{i}>go {rng.randrange(99)}</a>" for i in range(rng.randint(2, 8)))
    noise = [
        lambda: f"<nav><ul>{''.join(f'<li>{x}</li>' for x in links().split('</a> '))}</ul></nav>", lambda: f"<div class='ad'>{prose(60)}</div>", lambda: f"<footer>{prose(80)}</footer>", lambda: f"<div id='cookie-notice'><p>{prose(50)}</p></div>",
        lambda: f"<form><p>{prose(40)}</p><input></form>", lambda: f"<section class='comments'><p>{prose(70)}</p><p>ok</p></section>", lambda: f"<script>{prose(9)}<p></script>", lambda: f"<aside>{prose(90)}</aside>", lambda: f"<p>{links()}</p>",
    ]
    seen = Counter()
    for i in range(200):
        main = [prose(rng.choice([60, 80, 200])) if k % 2 == 0 else prose(rng.randint(1, 30)) for k in range(rng.choice([3, 5, 9]))]
        body = "".join(f"<p>{x.replace('&', '&amp;')}</p>" + (rng.choice(noise)() if i % 2 and rng.random() < 0.3 else "") for x in main)
        around = lambda: "".join(rng.choice(noise)() for _ in range(rng.randint(0, 4)))  # noqa: B023, E731
        page = f"<html><head><title>t</title></head><body>{around()}{f'<article>{body}</article>' if i % 2 else f'<div>{body}</div>'}{around()}</body></html>"
        assert html.main_text(page) == "\n".join(main), page
        seen += html.decisions(page)
    assert min(seen[k] for k in ("mark", "links", "words", "neighbours")) > 50


@pytest.mark.parametrize("piece", ["<a", "<div></p>", "<video>", "<!--", '<a "', "&", '<a x="> "', "</video ", "<head>", '<p class="a', "&#1", "</", "<p>", "<li>", "aaaa=", "<svg>", "\n", "<a '\"'>", "<p\n"])
def test_hostile_pages_end(piece):
    page = piece * (1_000_000 // len(piece))
    began = time.perf_counter()
    for text in (page, f"<p {page}>", f"<article><p>{page}</p><p>after</p></article>"):
        html.main_text(text)
    assert time.perf_counter() - began < 60


def test_numbers_of_any_length():
    assert html.main_text("<article><p>a&#" + "0" * 6000 + "65;b&#" + "1" * 6000 + ";c&#x" + "f" * 6000 + ";d</p></article>") == "aAb�c�d"


def test_dense_prose_outweighs_a_soft_class():
    prose = "This is what the people of the town said to us when we were there with them, and it was not what they had said before. " * 3
    page = '<article><p>{0}</p><p class="{1}">{2}</p><p>{0}</p></article>'
    kept = html.main_text(page.format(prose, "promo-code", prose + "Own words."))
    assert "Own words." in kept
    for mark, text in (("promo-code", "Buy now. Own words."), ("comment", prose + "Own words."), ("promo ad", prose + "Own words."), ("promo", f'<a href="x">{prose}</a> <a href="y">Own words.</a>')):
        assert "Own words." not in html.main_text(page.format(prose, mark, text))
    assert "Own words." not in html.main_text(f'<article><p>{prose}</p></article><p class="promo">{prose} Own words.</p>')
    assert "Own words." not in html.main_text(f'<article><p>{prose}</p><div class="related"><p>{prose} Own words.</p></div></article>')
