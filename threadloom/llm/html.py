"""Main text of web pages by two-pass block rules (operator 4).

A page is cut into blocks at block-level tags. The first pass decides what it
can about each block by itself: bad by its mark (menus, headers, footers,
sidebars, notices, adverts, forms, comments by element, role, class or id, where
an article's paragraph of long dense prose outweighs a class that may mean another
thing) or
its place outside the article, bad by its links (most of its text in several
links, or one of neighbouring blocks that are a link each), good by length and
stop-word density, and, outside articles, bad if it is long without stop words.
The second pass gives the ambiguous rest, short blocks and middling ones, the
label of the nearest neighbours that density decided; inside an article, where
ties and blocks without such neighbours are main text, marked blocks are passed
over for this.

Of a page's article elements those count that are the only one or hold prose:
a page of several without prose has teaser cards, and goes by the densities
alone like one without any.

One pass over Arrow batches, a page at a time; nothing is shuffled.

Defined results: null and empty pages give an empty text; text outside any
element counts as a block; unclosed elements end with the page, an unclosed
comment or script hides the rest; a tag that the page's end cuts off is text; a null ``page_id`` or ``url`` stays null;
repeated rows are extracted each; pages of any length are taken whole; other
columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import map_rows

#: Function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can do for from had has have he her his i in is it its not of on or our she
    so that the their there they this to was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die du ein eine einem einen einer er es für
    hat ich ihr im in ist mit nach nicht noch oder sein sich sie sind so über um und uns von war wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur mais ne nous on ou par pas
    plus pour qu que qui sa se ses son sur un une vous
    al como con de del el ella en era es esta este ha hay la las lo los más me mi muy no nos o para pero por que se
    sin sobre su sus también un una y ya
    """.split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Their whole content is no text.
HIDDEN = frozenset("applet audio canvas embed head iframe math noscript object script select style svg template textarea video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text.
OUTSIDE = frozenset("nav footer aside form dialog menu button fieldset search label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of a class or id that mark what is no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification "
    "overlay pager pagination paywall popup promo promotion promoted related recommended reply replies respond share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
HEADER_MARKS = frozenset("header topbar".split())
#: Of these, the ones that prose may have for other reasons: on a paragraph of an article, long dense prose outweighs them.
SOFT_MARKS = frozenset("banner modal notice notification popup promo promoted promotion recommended related share sharing signup social subscribe subscription teaser widget".split())
#: Every repeat is possessive, and is tried where something begins, never inside it.
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRS = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_ATTR = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_ZEROS = re.compile(r"&#0{9,}+")
_HUGE = re.compile(r"&#(?:[0-9]{9,}+|[xX]0*+[0-9a-fA-F]{9,}+);?")
_SPLIT = re.compile(r"[^a-zA-Z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")


class Rules(NamedTuple):
    link_density: float = 0.33
    article_link_density: float = 0.8
    short: int = 70
    long: int = 200
    stop_low: float = 0.15
    stop_high: float = 0.30


class Block(NamedTuple):
    text: str
    excluded: bool
    in_article: bool
    link_density: float
    heading: bool
    links: int = 0
    article: int = 0  # number of its article element, 0 for none
    soft: bool = False  # excluded by a soft mark of its own alone


def _marked(name: str, attrs: str, in_article: bool) -> str:
    """Whether an element's tag and attributes say that it is no main text: hard, soft or not at all."""
    if name in OUTSIDE or (name == "header" and not in_article):
        return "hard"
    if "=" not in attrs and "hidden" not in attrs:
        return ""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
    if re.search(r"(?:^|\s)hidden(?:\s|/|=|$)", attrs) and "hidden" not in (found.get("class", "") + found.get("id", "")) or found.get("aria-hidden") == "true":
        return "hard"
    if re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", found.get("style", "")):
        return "hard"
    if found.get("role", "").lower() in ROLES:
        return "hard"
    if name in ("html", "body", "main", "article") and "comment" not in attrs.lower():
        return ""  # a page's own classes name its parts: "has-sidebar"
    words = {w.lower() for w in _SPLIT.split(_CAMEL.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")) if w}
    if not words & MARKS and (in_article or not words & HEADER_MARKS):
        return ""
    return "soft" if in_article and name in ("p", "blockquote") and words & MARKS <= SOFT_MARKS else "hard"


def _decoded(text: str) -> str:
    """Character references decoded; numbers of any length are read."""
    if "&#" in text:
        text = _HUGE.sub("\N{REPLACEMENT CHARACTER}", _ZEROS.sub("&#0", text))
    return html.unescape(text)


class _Scanner:
    """Tags of a page from left to right; no place is read more than a few times.

    A page that ends inside the quotes of a tag is read with quotes up to there
    once; from that tag on quotes hide no ``>`` any more.
    """

    def __init__(self, page: str):
        self.page, self.at, self.last = page, 0, page.rfind(">")
        self.loose = False
        self.nowhere: set[str] = set()

    def next(self) -> tuple[str, str, bool, str] | None:
        """Text before the next tag, its name, whether it closes, its attributes; no name for the text before a comment or the end."""
        page, begin = self.page, self.at
        n = len(page)
        if begin >= n:
            return None
        lt = page.find("<", begin)
        while True:
            if lt < 0 or lt + 1 >= n:
                self.at = n
                return page[begin:], "", False, ""
            follow = page[lt + 1]
            if follow in "!?":
                self.at = self._past(lt)
                return page[begin:lt], "", False, ""
            if (follow == "/" or follow.isalpha()) and lt < self.last and (m := _NAME.match(page, lt)):
                end = self._end(m.end())
                self.at = end + 1
                return page[begin:lt], m[2].lower(), bool(m[1]), page[m.end() : end]
            lt = page.find("<", lt + 1)

    def _past(self, lt: int) -> int:
        page, n = self.page, len(self.page)
        for mark, shut in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
            if page.startswith(mark, lt):
                end = page.find(shut, lt + max(2, len(mark)))
                return n if end < 0 else end + len(shut)
        return n

    def _end(self, at: int) -> int:
        """Where the tag whose attributes begin here ends."""
        if not self.loose:
            end = _ATTRS.match(self.page, at).end()
            if end < len(self.page) and self.page[end] == ">":
                return end
            self.loose = True
        return self.page.find(">", at)

    def find(self, pattern: str) -> re.Match | None:
        """Where a pattern comes next, before the page's last ``>``; looked for in vain once."""
        if pattern in self.nowhere:
            return None
        m = re.compile(pattern, re.I).search(self.page, self.at)
        if m is None or m.end() > self.last:
            self.nowhere.add(pattern)
            return None
        return m


def blocks_of(page: str) -> tuple[list[Block], bool]:
    """The page's blocks in order, and whether it has an article element."""
    blocks: list[Block] = []
    parts: list[str] = []
    linked = links_open = links = articles = 0
    heading = False
    stack: list[tuple[str, str, int]] = []  # name, exclusion, article
    opened: Counter = Counter()  # names in the stack
    excluded, article = "", 0
    scan = _Scanner(page)

    def end() -> None:
        nonlocal linked, links, heading
        if parts:
            text = " ".join(_decoded("".join(parts)).split())
            if text:
                blocks.append(Block(text, excluded != "", article > 0, min(1.0, linked / max(len(text), 1)), heading, max(links, linked > 0), article, excluded == "soft"))
            parts.clear()
        linked, links, heading = 0, 0, False

    while (found := scan.next()) is not None:
        text, name, closing, attrs = found
        if text:
            parts.append(text)
            if links_open:
                linked += len(text.strip())
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif name in HIDDEN or name == "title":
            if name != "head":
                end() if name not in ("svg", "math") else None
            if not closing and not attrs.endswith("/"):
                shut = scan.find(rf"</{re.escape(name)}(?=[\s/>])")
                if shut:
                    scan.at = page.find(">", shut.end()) + 1
                elif name == "head":  # an unclosed head ends where the body begins
                    body = scan.find(r"<body(?=[\s>])")
                    scan.at = body.start() if body else scan.at
                elif name in RAW and name not in VOID:
                    scan.at = len(page)
        elif name == "a":
            links_open = max(0, links_open - 1) if closing else 1
            links += not closing
        elif name in BLOCKS or name in OUTSIDE:
            end()
            if name in VOID:
                continue
            if closing:
                if opened[name]:
                    while True:
                        gone = stack.pop()[0]
                        opened[gone] -= 1
                        if gone == name:
                            break
            else:
                if name in ("p", "li", "dt", "dd", "option") and stack and stack[-1][0] == name:
                    opened[stack.pop()[0]] -= 1
                outer = stack[-1] if stack else ("", "", 0)
                begins = name in ("article", "main") or bool(re.search(r"\brole\s*+=\s*+[\"']?main\b|itemprop\s*+=\s*+[\"']?articleBody", attrs))
                out = "hard" if outer[1] else _marked(name, attrs, outer[2] > 0)
                if begins and not out and not outer[2]:
                    articles += 1
                stack.append((name, out, outer[2] or (articles if begins and not out else 0)))
                opened[name] += 1
                if name == "p" and len(stack) > 1 and stack[-2][0] == "p":
                    del stack[-2]
                    opened["p"] -= 1
            excluded, article = (stack[-1][1], stack[-1][2]) if stack else ("", 0)
            heading = not closing and len(name) == 2 and name[0] == "h"
    end()
    return blocks, articles > 0


def _words(b: Block, rules: Rules) -> str:
    """good or bad by length and stop words, else near or short."""
    if len(b.text) < rules.short:
        return "short"
    words = _WORD.findall(b.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if density >= rules.stop_high and len(b.text) > rules.long:
        return "good"
    return "near" if density >= rules.stop_low or len(b.text) <= rules.long else "bad"


def _first_pass(blocks: list[Block], has_article: bool, rules: Rules) -> list[tuple[str, str]]:
    """Label and what decided it: good or bad, or short or near if nothing did."""
    words = ["" if b.excluded and not b.soft else _words(b, rules) for b in blocks]
    prose = {b.article for b, w in zip(blocks, words, strict=True) if w == "good" and not b.excluded} - {0}
    held = prose or ({1} if has_article and all(b.article <= 1 for b in blocks) else set())
    linked = [not b.excluded and b.link_density >= (rules.article_link_density if b.article in held else rules.link_density) for b in blocks]
    out = []
    for i, (b, w) in enumerate(zip(blocks, words, strict=True)):
        inside = b.article in held
        if b.excluded and not (b.soft and inside and w == "good" and b.link_density < rules.link_density):
            out.append(("bad", "mark"))
        elif held and not inside:
            out.append(("bad", "place"))
        elif linked[i] and (b.links > 1 or not inside or any(0 <= j < len(blocks) and linked[j] and (blocks[j].article in held) == inside for j in (i - 1, i + 1))):
            out.append(("bad", "links"))
        elif w == "good" or (w == "bad" and not inside):
            out.append((w, "words"))
        elif w == "short" and b.link_density > 0 and not inside:
            out.append(("bad", "links"))
        else:
            out.append(("near" if w == "bad" else w, "inside" if inside else "alone"))
    return out


def decide(blocks: list[Block], has_article: bool, rules: Rules) -> list[tuple[bool, str]]:
    """For each block whether it is main text, and what decided it."""
    first = _first_pass(blocks, has_article, rules)
    n = len(first)
    place, at = [], 0  # marked blocks take no room
    for _, why in first:
        place.append(at)
        at += why != "mark"

    def neighbours(order) -> list[tuple[str, int] | None]:
        seen: dict[bool, tuple[str, int]] = {}
        found: list = [None] * n
        for i in order:
            label, why = first[i]
            found[i] = seen.get(why == "inside")
            if label in ("good", "bad"):
                if why in ("links", "words"):
                    seen[True] = (label, i)
                seen[False] = (label, i)
        return found

    before, after = neighbours(range(n)), neighbours(range(n - 1, -1, -1))
    any_near = any(label == "near" for label, _ in first)
    out = []
    for i, (label, why) in enumerate(first):
        if label in ("good", "bad"):
            out.append((label == "good", why))
            continue
        inside, a, b = why == "inside", before[i], after[i]
        if a is None and b is None:  # nothing decided near it: its place does, or prose stays
            out.append((inside or label == "near" or not any_near, "place" if inside else "alone"))
            continue
        if blocks[i].heading and b is not None:  # a heading goes with what it heads
            near = b[0]
        elif a is None or b is None:
            near = (a or b)[0]
        elif a[0] == b[0] or place[i] - place[a[1]] < place[b[1]] - place[i]:
            near = a[0]
        elif place[i] - place[a[1]] > place[b[1]] - place[i]:
            near = b[0]
        else:
            near = "good" if inside or label == "near" else "bad"
        out.append((near == "good", "neighbours"))
    return out


def classify(blocks: list[Block], has_article: bool, rules: Rules) -> list[bool]:
    """True for each block of the main text."""
    return [keep for keep, _ in decide(blocks, has_article, rules)]


def decisions(page: str | None, rules: Rules = Rules()) -> Counter:
    """How many of a page's blocks each rule decided: mark, place, links, words, neighbours, alone."""
    return Counter(why for _, why in decide(*blocks_of(page or ""), rules))


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    if not page:
        return ""
    blocks, has_article = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, classify(blocks, has_article, rules), strict=True) if keep)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def make():
        def work(rows):
            texts = [main_text(r[2], rules) for r in rows]
            return [(r[0], r[1], t, len(t)) for r, t in zip(rows, texts, strict=True)]

        return work

    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")), make, schema, weigh=2)


def op4_query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
