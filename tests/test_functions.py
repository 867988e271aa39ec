import datetime as dt
import random
import re
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from threadloom.functions import links, markup, scalar


def values(spark, cases, expr):
    df = spark.createDataFrame([(i, *(c if isinstance(c, tuple) else (c,))) for i, c in enumerate(cases)], "i int, a string" + (", b string" if isinstance(cases[0], tuple) else ""))
    return [r[1] for r in sorted(df.select("i", expr.alias("v")).collect())]


def test_times(spark):
    got = values(spark, ["Wed Oct 10 20:19:24 +0000 2018", "2018-10-10T20:19:24.000Z", "garbage", "", None], F.date_format(scalar.archive_time("a"), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2018-10-10 20:19:24", "2018-10-10 20:19:24", None, None, None]
    assert values(spark, ["1838969711670776106", "abc", None], F.date_format(scalar.snowflake_time("a"), "yyyy-MM-dd HH:mm:ss.SSS")) == ["2024-09-25 15:52:00.324", None, None]


def test_ids(spark):
    assert values(spark, ["1", "12345678901234567890", "9223372036854775808", "x", "", "007"], scalar.valid_id("a")) == [True, False, False, False, False, True]


def test_clean_text(spark):
    cases = ["@a hello  #tag https://x.y world", "  plain\ttext\n", "", "#only @marks http", "a b"]
    want = [" ".join(w for w in c.split() if not w.startswith(("@", "http", "#"))) for c in cases]
    assert values(spark, cases, scalar.clean_text("a")) == want
    assert values(spark, ["@b @a #x @b"], F.array_join(scalar.marked_words("a", "@"), ",")) == ["a,b"]


def test_names_and_previews(spark):
    assert values(spark, ["/x/y/ann_archive.json", "bob.json", "c_archive_archive.json"], scalar.user_of_file("a")) == ["ann", "bob", "c_archive"]
    assert values(spark, [None, "abc"], scalar.preview("a", 2)) == ["[NULL]", "ab..."]
    assert values(spark, ["a b-c_1"], scalar.safe_name("a")) == ["a_b_c_1"]


URLS = [
    "https://user:pw@Example.com:8080/a/b;p?q=1#f", "http://x.com", "//cdn.net/x", "mailto:a@b.c", "http://a.b/c|d?e|f", "HTTPS://UP.case/P", "no-scheme/path", "", "http://h?q#f", "http://h/a;b/c;d?x=#y?z",
]


def test_url_parts_equal_urlparse(spark):
    for k, attr in {"protocol": "scheme", "raw_domain": "netloc", "path": "path", "query": "query", "fragment": "fragment"}.items():
        assert values(spark, URLS, links.parts("a")[k]) == [getattr(urlparse(u), attr) for u in URLS], k


@pytest.mark.parametrize(
    "domain, site",
    [
        ("www.youtube.com", "youtube.com"), ("youtu.be", "youtube.com"), ("m.youtube.com", "youtube.com"), ("twitter.com", "twitter.com"), ("x.com", "twitter.com"), ("subdomain.x.com", "twitter.com"),
        ("api.twitter.com", "twitter.com"), ("en.wikipedia.org", "wikipedia.org"), ("ja.wikipedia.org", "wikipedia.org"), ("a.medium.com", "medium.com"), ("medium.com", "medium.com"), ("gist.github.com", "github.com"),
        ("Example.COM", "example.com"), ("foox.com", "foox.com"),
    ],
)
def test_sites(spark, domain, site):
    assert values(spark, [domain], links.normalized("a")) == [site]


def test_groups_and_shorteners(spark):
    assert values(spark, ["www.m.github.com", "bit.ly", "m.co", "fr.m.wikipedia.org", "www.x.com"], links.grouped("a")) == ["github.com", "deprecated_links", "m.co", "wikipedia.org", "twitter.com"]
    assert values(spark, ["t.co", "youtube.com"], links.is_shortener("a")) == [True, False]
    assert values(spark, ["https://t.co/x", "https://dlvr.it/x"], links.needs_resolving("a")) == [True, False]


def test_link_extraction_equals_pattern(spark):
    texts = ["a https://t.co/abc123, b", "https://www.twitter.com/ann/status/12?s=20 x", "http://a.b/%20c)d {http://e.f}", "none", "https://é.fr/ü"]
    py = re.compile(r"https?://(?:(?:www\.)?twitter\.com/[a-zA-Z0-9_]+/status/[0-9]+|(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+)")
    assert values(spark, texts, F.array_join(links.found_in("a"), " ")) == [" ".join(py.findall(t)) for t in texts]


def test_quoted_ids(spark):
    q = links.quoted_id(F.split("a", " "), F.lit("5"), F.col("b") == "q", F.lit("77"))
    cases = [("https://twitter.com/a/status/12?s=1", "n"), ("https://twitter.com/a/status/5", "q"), ("https://twitter.com/a/status/x", "n"), ("https://x.com/a/status/9", "n"), ("https://twitter.com/a/status/1/status/8/photo", "n")]
    assert values(spark, cases, q) == [12, 77, None, None, 8]


def test_handlers_and_skips(spark):
    assert values(spark, ["https://www.youtube.com/x", "https://x.com/a", "https://github.com/a/b", "https://a.b"], links.handler("a")) == ["video", "post", "repository", "page"]
    assert values(spark, [("http://a/x.PNG", "text/html"), ("http://a/x", "image/png"), ("http://a", "application/json"), ("http://a", "text/html; charset=x")], links.skip_reason("a", "b")) == ["media file", "binary content", "non-HTML content", None]


PAGE = """<html><head><title>A &amp; B</title><meta name="description" content="D"><meta name="keywords" content="k1"><meta property="og:title" content="OT">
<meta property="og:description" content="OD"><script>var x = 1;</script><style>p{}</style></head><body><header>Head</header><nav><a href="/rel">r</a></nav>
<main><p>Text  two   spaces</p><a href="https://a.b/c">l</a><img src="https://i.j/k.png"><img src="/rel.png"></main><footer>Foot</footer></body></html>"""


def test_page_metadata(spark):
    r = spark.createDataFrame([(PAGE,), (None,), ("<title>t",)], "html string").select(markup.page_of("html").alias("p")).select("p.*").collect()
    a = r[0]
    assert (a["title"], a["description"], a["keywords"], a["og_title"], a["og_description"], a["links"], a["images"]) == ("A & B", "D", "k1", "OT", "OD", ["https://a.b/c"], ["https://i.j/k.png"])
    assert "Text two spaces" in a["text_content"] and not re.search("Head|Foot|var x", a["text_content"])
    assert r[1]["title"] is None and r[1]["links"] == [] and r[2]["title"] == "t"


def test_percent_and_days(spark):
    one = spark.range(1)
    assert one.select(scalar.percent(F.lit(1), F.lit(3))).first()[0] == 33.33
    assert one.select(scalar.percent(F.lit(1), F.lit(0))).first()[0] is None
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12)
    assert spark.createDataFrame([(a, b)], "a timestamp, b timestamp").select(scalar.days_between("a", "b")).first()[0] == 1.5
    assert random is not None
