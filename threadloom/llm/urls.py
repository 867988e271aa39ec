"""URL filters by association rules (operator 2).

Each url becomes a set of tokens (host labels, path words, extension, query
keys, fragment). FP-growth over the labelled urls that are bad mines token
combinations; their confidence is counted over all labelled urls, only rules of
enough support, confidence and lift stay, and those that a shorter rule of no
less confidence implies are pruned. Rules are filed under their rarest token,
and a url tries only the rules of its own tokens.

Only tokens that go with bad urls more often than chance, and in enough of them,
take part; tokens that always stand together count as one; one whose own rule has
no exception cannot be bettered by a longer one and is left out of them. Where no
url has more than ``URL_TOKENS`` such tokens, FP-growth combines them. Beyond that
its sets would be too many, and the same growth of patterns over conditional
tables goes token by token, as joins: a set is extended only in the urls that hold
it, and no further if it is too rare, has no exception, or stands where a smaller
set does. What that leaves out a smaller rule implies, so both ways give the same
rules.

A page's label is that of the document whose number its path ends in; a
document is bad if its quality is 0 or it is toxic. The rules are fitted on at
most ``LABELLED`` urls by hash order. A host/path list of fixed rules goes
before what is mined.

Up to ``RULES`` mined rules travel inside the plan; more are joined to the
distinct token sets by the token they are filed under.

Defined results: a null url and one without ``://`` have an empty host and path
and no tokens, so the verdict is allow; a null ``page_id`` is judged like any
other; repeated rows are judged each; urls of any length are taken whole; ties
in a url's tokens go by confidence, number, then name; without labels nothing is
mined and all that no fixed rule blocks is allowed; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import written

#: host, path, verdict
FIXED = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
LABELLED = 200_000
RULES = 5_000
#: Tokens of a labelled url up to which FP-growth lists all sets: 2 ** URL_TOKENS of it at most.
URL_TOKENS = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def with_parts(pages: DataFrame) -> DataFrame:
    u = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return (
        pages.select(F.col("page_id").cast("long").alias("page_id"), u.alias("u"))
        .withColumn("host", F.translate(F.regexp_extract("u", _PARTS, 1), _UPPER, _LOWER))
        .withColumn("path", F.regexp_extract("u", _PARTS, 2))
    )


def tokens() -> Column:
    """Typed tokens of ``u, host, path``; numbers are left out."""
    u, host, path = F.col("u"), F.col("host"), F.col("path")
    tag = lambda t, xs: F.transform(F.filter(xs, lambda x: (x != "") & ~x.rlike(r"^\d+$")), lambda x: F.concat(F.lit(t), F.lower(x)))
    labels = F.split(F.regexp_replace(host, r":\d+$", ""), r"\.")
    words = F.split(F.regexp_replace(path, r"\.\w{1,5}$", ""), r"[^\p{L}\p{N}]+")
    ext = F.array(F.regexp_extract(path, r"\.(\w{1,5})$", 1))
    keys = F.transform(F.split(F.regexp_extract(u, _PARTS, 3), "&"), lambda x: F.substring_index(x, "=", 1))
    frag = F.array(F.regexp_extract(u, _PARTS, 4))
    return F.array_distinct(F.concat(tag("h=", labels), tag("p=", words), tag("x=", ext), tag("q=", keys), tag("f=", frag)))


def labelled(parts: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """``tokens, bad`` (0 or 1) of at most ``most`` labelled urls."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    mark = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(bad, F.lit(0)).alias("bad")).where("doc_id is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    number = F.regexp_extract("path", r"/(\d{1,18})(?:[/.][^/]*)?$", 1)
    urls = parts.withColumn("doc_id", F.when(number != "", number.cast("long"))).where("doc_id is not null")
    return urls.join(mark, "doc_id").select("bad", "u", "tokens").orderBy(F.xxhash64("u"), "u", "bad").limit(most).select("tokens", "bad")


def mine(rows: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8, min_lift: float = 1.5, min_rows: int = 5, url_tokens: int = URL_TOKENS) -> DataFrame | None:
    """``key, rule, confidence``: rules filed under their rarest token."""
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"), "url-rows")
    n, n_bad = rows.agg(F.count("*"), F.sum("bad")).first()
    if n < min_rows or not n_bad:
        return None
    base, least = n_bad / n, max(min_rows, math.ceil(min_support * n))
    good_enough = (F.col("bad") >= least) & (F.col("bad") >= min_confidence * F.col("n")) & (F.col("bad") >= min_lift * base * F.col("n"))
    said = rows.select("row", "bad", F.explode("tokens").alias("key"))
    # where a token stands, as a sum of row digests: equal for tokens that always stand together
    stands = [F.expr("bit_xor(xxhash64(row))").alias("x"), F.sum(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(1 << 40))).alias("y")]
    counts = said.groupBy("key").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), *stands).where((F.col("bad") >= least) & (F.col("bad") > base * F.col("n")))
    strong = written(counts.groupBy("n", "bad", "x", "y").agg(F.min("key").alias("key")).select("key", "n", "bad"), "url-tokens")
    singles = strong.where(good_enough).select(F.array("key").alias("rule"), (F.col("bad") / F.col("n")).alias("confidence"))
    own = written(said.join(strong.where("bad < n").select("key"), "key").select("row", "bad", "key"), "url-own")
    bad_urls = own.where("bad = 1").groupBy("row").agg(F.array_sort(F.collect_list("key")).alias("items")).where("size(items) > 1")  # of one url
    baskets = written(bad_urls.select("items"), "url-baskets")
    found = singles
    n_baskets, longest = baskets.agg(F.count("*"), F.max(F.size("items"))).first()
    if n_baskets >= least:
        if longest <= url_tokens:
            every = FPGrowth(itemsCol="items", minSupport=least / n_baskets, minConfidence=1.0).fit(baskets).freqItemsets
            sets = written(every.where("size(items) > 1").select(F.array_sort("items").alias("rule")), "url-sets")
        else:
            sets = _grown(own, strong, least)
        tried = _filed(sets, strong)
        fits = F.size(F.array_except("rule", "tokens")) == 0
        met = rows.select("tokens", "bad", F.explode("tokens").alias("key")).join(tried, "key").where(fits).groupBy("rule").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
        found = singles.union(met.where(good_enough).select("rule", F.col("bad") / F.col("n")))
    filed = written(_filed(found, strong), "url-filed")
    longer = filed.select(F.col("rule").alias("long"), F.col("confidence").alias("c"), F.explode("rule").alias("key"))
    implied = longer.join(filed, "key").where((F.size("rule") < F.size("long")) & (F.size(F.array_except("rule", "long")) == 0) & (F.col("confidence") >= F.col("c"))).select(F.col("long").alias("rule")).distinct()
    return written(filed.join(implied, "rule", "left_anti").select("key", "rule", "confidence"), "url-mined")


def _grown(own: DataFrame, strong: DataFrame, least: int) -> DataFrame:
    """``rule``: sets of two tokens and more in ``least`` bad urls, but for those that a smaller set stands for.

    ``own`` has ``row, bad, key``. Each round extends the open sets of the last
    by a later token of their rows; a new set must stand in fewer rows than each
    set with a token less, and all of these must be open.
    """
    c = F.col
    open_ = strong.where("bad < n").select(F.array("key").alias("rule"), "n")
    held = own.select("row", "bad", F.array("key").alias("rule"), c("key").alias("last"))
    rounds: list[DataFrame] = []
    while True:
        longer = held.join(own.select("row", "key"), "row").where("key > last").select("row", "bad", F.array_append("rule", c("key")).alias("rule"), c("key").alias("last"))
        counted = longer.groupBy("rule").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).where(c("bad") >= least)
        less = counted.select("rule", c("n").alias("m"), F.posexplode("rule")).select("rule", "m", F.filter("rule", lambda x: x != c("col")).alias("part"))
        free = less.join(open_.select(c("rule").alias("part"), "n"), "part").where("n > m").groupBy("rule").count().where(c("count") == F.size("rule")).select("rule")
        sets = written(counted.join(free, "rule"), "url-grown")
        rounds.append(sets.select("rule"))
        open_ = sets.where("bad < n").select("rule", "n")
        if open_.isEmpty():
            break
        held = written(longer.join(open_.select("rule"), "rule"), "url-held")
    out = rounds[0]
    for more in rounds[1:]:
        out = out.union(more)
    return out


def _filed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """``rules`` with their rarest token as ``key``."""
    rest = [c for c in rules.columns if c != "rule"]
    each = rules.select("rule", *rest, F.explode("rule").alias("key")).join(counts.select("key", "n"), "key")
    return each.groupBy("rule", *rest).agg(F.min_by("key", F.struct("n", "key")).alias("key"))


def with_verdict(parts: DataFrame, rules: DataFrame | None, most_rules: int = RULES) -> DataFrame:
    """Adds ``mined``: true where a mined rule fits the tokens."""
    if rules is None:
        return parts.withColumn("mined", F.lit(False))
    if rules.count() <= most_rules:
        index: dict[str, list] = {}
        for r in rules.collect():
            index.setdefault(r["key"], []).append(list(r["rule"]))
        table = F.from_json(F.lit(json.dumps(index)), "map<string,array<array<string>>>")
        fits = lambda rule: F.size(F.array_except(rule, F.col("tokens"))) == 0
        return parts.withColumn("mined", F.exists("tokens", lambda t: F.coalesce(F.exists(F.try_element_at(table, t), fits), F.lit(False))))
    sets = parts.select("tokens").distinct()
    hit = sets.select("tokens", F.explode("tokens").alias("key")).join(rules, "key").where(F.size(F.array_except("rule", "tokens")) == 0).select("tokens").distinct().withColumn("mined", F.lit(True))
    return parts.join(hit, "tokens", "left").withColumn("mined", F.coalesce("mined", F.lit(False)))


def fixed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fixed rule that fits, and its verdict; nulls if none does."""
    rule = verdict = None
    for h, p, v in sorted(FIXED, key=lambda r: -len(r[0] + r[1])):
        cond = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(cond, h + p) if rule is None else rule.when(cond, h + p)
        verdict = F.when(cond, v) if verdict is None else verdict.when(cond, v)
    return rule, verdict


def judge(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` of every url."""
    parts = with_parts(pages).withColumn("tokens", tokens())
    rules = mine(labelled(parts, labels), **options)
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    return with_verdict(parts, rules).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined"
    )


def op2_query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
