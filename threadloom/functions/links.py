"""Column functions on urls and domains, without look-around, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.scalar import c

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Sites and their names.
SITES = {
    "twitter.com": ["twitter.com", "x.com"],
    "youtube.com": ["youtube.com", "youtu.be", "m.youtube.com"],
    "wikipedia.org": ["wikipedia.org"],
    "github.com": ["github.com", "raw.githubusercontent.com", "gist.github.com"],
}
SUBDOMAINS = {".x.com": "twitter.com", ".twitter.com": "twitter.com", ".wikipedia.org": "wikipedia.org", ".medium.com": "medium.com", ".substack.com": "substack.com"}
SHORTENERS = ["t.co", "bit.ly", "goo.gl", "tinyurl.com", "ow.ly", "buff.ly", "dlvr.it", "is.gd", "tiny.cc", "j.mp", "ift.tt", "amzn.to"]
GROUP_SHORTENERS = ["t.co", "bit.ly", "buff.ly", "tinyurl.com", "ow.ly", "goo.gl", "tiny.cc", "is.gd"]
GROUPS = {
    "twitter.com": ["twitter.com", "x.com"],
    "youtube.com": ["youtube.com", "youtu.be"],
    "wikipedia.org": ["wikipedia.org", "en.wikipedia.org", "fr.wikipedia.org", "de.wikipedia.org"],
    "github.com": ["github.com", "raw.githubusercontent.com", "gist.github.com"],
}
#: Urls in running text; the second alternative's $-_ spans 0x24 to 0x5F.
LINK = r"https?://(?:(?:www\.)?twitter\.com/[a-zA-Z0-9_]+/status/[0-9]+|(?:[a-zA-Z0-9$-_@.&+!*(),]|%[0-9a-fA-F][0-9a-fA-F])+)"
PLAIN_LINK = r"https?://[^\s]+"
INTERNAL = r"https?://(?:(?:www\.|m\.)?twitter\.com|x\.com)/\w+/status/"
MEDIA_FILE = r"(?i)\.(?:jpg|jpeg|png|gif|pdf|zip)$"
BINARY_TYPES = ["application/pdf", "application/zip", "image/", "video/", "audio/", "application/octet-stream", "application/x-binary"]


def parts(url: Column | str) -> dict[str, Column]:
    """scheme, netloc, path, query, fragment; what is not there is ''."""
    u = F.coalesce(c(url), F.lit(""))
    get = lambda i: F.regexp_extract(u, _SPLIT, i)
    return {"protocol": F.lower(get(1)), "raw_domain": get(2), "path": F.regexp_replace(get(3), r";[^/]*$", ""), "query": get(4), "fragment": get(5)}


def normalized(domain: Column | str) -> Column:
    """One name for a site's domains."""
    d = F.regexp_replace(F.lower(c(domain)), r"^www\.", "")
    out = None
    for site, names in SITES.items():
        out = F.when(d.isin(names), site) if out is None else out.when(d.isin(names), site)
    for tail, site in SUBDOMAINS.items():
        out = out.when(d.endswith(tail), site)
    return out.otherwise(d)


def grouped(domain: Column | str) -> Column:
    """The older grouping: every ``www.`` and an inner ``m`` label go, shorteners are one."""
    d = F.replace(F.lower(c(domain)), F.lit("www."), F.lit(""))
    labels = F.split(d, r"\.")
    at = F.array_position(labels, "m").cast("int")
    d = F.when((at > 0) & (at < F.size(labels) - 1), F.array_join(F.filter(labels, lambda x, i: i != at - 1), ".")).otherwise(d)
    out = None
    for site, names in GROUPS.items():
        out = F.when(d.isin(names), site) if out is None else out.when(d.isin(names), site)
    for tail in (".substack.com", ".medium.com"):
        out = out.when(d.endswith(tail), tail[1:])
    return out.when(d.isin(GROUP_SHORTENERS), "deprecated_links").otherwise(d)


def is_shortener(domain: Column | str) -> Column:
    return c(domain).isin(SHORTENERS)


def needs_resolving(url: Column | str) -> Column:
    return parts(url)["raw_domain"].isin(GROUP_SHORTENERS)


def found_in(text: Column | str, pattern: str = LINK) -> Column:
    return F.regexp_extract_all(c(text), F.lit(pattern), F.lit(0))


def is_internal(url: Column | str) -> Column:
    return F.coalesce(c(url).rlike(INTERNAL), F.lit(False))


def is_absolute(url: Column | str) -> Column:
    p = parts(url)
    return (p["protocol"] != "") & (p["raw_domain"] != "")


def _first(url: Column | str, *patterns: str) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(c(url), p, 1), F.lit("")) for p in patterns])


def video_id(url):
    return _first(url, r"(?:youtube\.com/watch\?v=|youtu\.be/)([a-zA-Z0-9_-]+)", r"youtube\.com/shorts/([a-zA-Z0-9_-]+)")


def post_id(url):
    return _first(url, r"(?:twitter|x)\.com/\w+/status/(\d+)", r"(?:twitter|x)\.com/\w+/statuses/(\d+)")


def repo_owner(url):
    return _first(url, r"github\.com/([^/]+)/[^/]+")


def repo_name(url):
    return _first(url, r"github\.com/[^/]+/([^/]+)")


def photo_id(url):
    return _first(url, r"instagram\.com/p/([^/]+)", r"instagram\.com/reel/([^/]+)")


def handler(url: Column | str) -> Column:
    """Which reader a page asks for."""
    d = F.lower(parts(url)["raw_domain"])
    return (
        F.when(d.contains("youtube.com") | d.contains("youtu.be"), "video")
        .when(d.contains("twitter.com") | d.contains("x.com"), "post")
        .when(d.contains("github.com"), "repository")
        .otherwise("page")
    )


def skip_reason(url: Column | str, content_type: Column | str) -> Column:
    """Why a page's content is not read; null if it is."""
    kind = F.lower(F.coalesce(c(content_type), F.lit("")))
    binary = F.exists(F.array(*map(F.lit, BINARY_TYPES)), lambda b: kind.contains(b))
    return F.when(c(url).rlike(MEDIA_FILE), "media file").when(binary, "binary content").when(~kind.contains("text/html"), "non-HTML content")


def quoted_id(urls: Column | str, own_id: Column | str, is_quote: Column | str, quoted_status: Column | str) -> Column:
    """Id of the quoted post: from links to posts, else from the quote fields."""
    posts = F.filter(c(urls), lambda u: u.contains("twitter.com") & u.contains("/status/"))
    ids = F.transform(posts, lambda u: F.regexp_extract(u, r"^.*/status/(\d+)", 1))
    fit = F.filter(ids, lambda i: (i != "") & (i != c(own_id)) & (F.length(i) <= 19))
    return F.coalesce(F.get(fit, 0), F.when(c(is_quote), c(quoted_status))).try_cast("bigint")


def fetch_status(status_code: Column | str, error: Column | str, skipped: Column | str) -> Column:
    code = c(status_code)
    return F.when(c(skipped).isNotNull(), "skipped").when(c(error).isNotNull(), "failed").when(code == 200, "success").when(code.isNotNull(), "failed").otherwise("not_attempted")
