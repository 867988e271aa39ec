import itertools
import random
import re

from threadloom.llm import urls


def slow_parts(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def slow_rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in urls.FIXED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.COM", "http://a.com/", "https://WWW.Example.com/en/1", "https://example.com/en/2", "https://x.www.example.com/en/", "https://b.example.com/fr/1",
    "http://c.net/es/5?x=http://d.com/", "http://c.net/fr/", "http://c.net/de/", "ftp://notexample.com/en/x", "http://com/", "http://net/fr/9", "a://b://c/d", "http://ü.Net/es/Ä#f", "http://h.org?q#f", "http://e.com:80/en/1",
    "http://x.com\n/en/3",
]


def pages(spark, us):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(us)], "page_id long, url string, host string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_parts_and_fixed_rules(spark):
    out = {r["page_id"]: r for r in urls.judge(pages(spark, URLS), labels(spark, [])).collect()}
    for i, u in enumerate(URLS):
        host, path = slow_parts(u)
        rule, verdict = slow_rule(host, path)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == (host, path, rule, verdict or "allow"), u


def training(n=400):
    us = [f"http://{'bad' if i % 5 == 0 else 'good'}{i % 3}.org/{'win' if i % 5 == 0 or i % 7 == 0 else 'news'}/{i}" for i in range(n)]
    return us, [(i, 0 if i % 5 == 0 else 1, 0) for i in range(0, n, 2)]


def test_mined_rules_block_and_both_ways_agree(spark):
    us, marks = training()
    p, lab = pages(spark, us), labels(spark, marks)
    parts = urls.with_parts(p).withColumn("tokens", urls.tokens())
    rules = urls.mine(urls.labelled(parts, lab))
    mined = [(set(r["rule"]), r["confidence"]) for r in rules.collect()]
    assert mined and all(c >= 0.8 for _, c in mined)
    for r, c in mined:  # none is implied by a shorter one
        assert not any(s < r and d >= c for s, d in mined)
    rows = parts.select("page_id", "tokens").collect()
    want = {r["page_id"] for r in rows if any(s <= set(r["tokens"]) for s, _ in mined)}
    for most in (urls.RULES, 0):
        got = {r["page_id"] for r in urls.with_verdict(parts, rules, most).where("mined").collect()}
        assert got == want == {i for i in range(400) if i % 5 == 0}
    assert {r["page_id"] for r in urls.judge(p, lab).where("verdict = 'block'").collect()} == want


def test_edges(spark):
    lab = labels(spark, [(1, 0, 0), (1, 1, 1), (None, 0, 0), (2, None, None)])
    assert urls.judge(pages(spark, []).limit(0), lab).count() == 0
    twice = pages(spark, URLS).union(pages(spark, URLS))
    assert urls.judge(twice, lab).count() == 2 * len(URLS)
    assert not re.search("Python|Pandas|Arrow", urls.judge(pages(spark, URLS), lab)._jdf.queryExecution().toString().replace("ExistingRDD", ""))


def brute_rules(rows, least, confidence, lift):
    """Every combination of tokens, counted one by one."""
    base = sum(b for _, b in rows) / len(rows)
    count = lambda rule: (sum(rule <= t for t, _ in rows), sum(b for t, b in rows if rule <= t))
    kinds = {}
    for t in sorted(set().union(*(t for t, _ in rows))):
        n, bad = count({t})
        if bad >= least and bad > base * n:
            kinds.setdefault(frozenset(i for i, (x, _) in enumerate(rows) if t in x), t)
    found = {}
    for k in range(1, len(kinds) + 1):
        for rule in map(frozenset, itertools.combinations(kinds.values(), k)):
            n, bad = count(rule)
            if bad >= least and bad >= confidence * n and bad >= lift * base * n:
                found[rule] = bad / n
    return {r: c for r, c in found.items() if not any(s < r and d >= c for s, d in found.items())}


def test_mining_matches_brute_force(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = []
        for _ in range(120):
            t = {f"t{i}" for i in range(9) if rng.random() < 0.4}
            t |= {f"same{i}" for i in range(3)} if "t0" in t else set()
            bad = int({"t1", "t2"} <= t or ("t3" in t and rng.random() < 0.7) or rng.random() < 0.1)
            rows.append((t, bad))
        df = spark.createDataFrame([(sorted(t), b) for t, b in rows], "tokens array<string>, bad int")
        want = {r: round(c, 9) for r, c in brute_rules(rows, 5, 0.8, 1.5).items()}
        for most in (urls.URL_TOKENS, 1) if seed % 2 else (1,):  # by FP-growth and token by token
            got = {frozenset(r["rule"]): round(r["confidence"], 9) for r in urls.mine(df, url_tokens=most).collect()}
            assert got == want and want, (seed, most)


def test_a_rule_that_needs_twelve_tokens(spark):
    """Each good url lacks one of them."""
    twelve = [f"t{i:02}" for i in range(12)]
    rows = [(twelve, 1)] * 20 + [([t for t in twelve if t != lacking], 0) for lacking in twelve for _ in range(8)]
    df = spark.createDataFrame(rows, "tokens array<string>, bad int")
    for most in (12, 11):
        assert [(sorted(r["rule"]), r["confidence"]) for r in urls.mine(df, url_tokens=most).collect()] == [(twelve, 1.0)]


def test_urls_of_hundreds_of_words_end(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    us, marks = [], []
    for i in range(410):
        bad = i < 10
        path = [w for w in words[:40] if rng.random() < 0.95] if bad else rng.sample(words, 30)
        us.append(f"http://h{i % 7}.org/{'/'.join(path)}/{i}")
        marks.append((i, int(not bad), 0))
    us.append("http://long.org/" + "/".join(f"x{i}" for i in range(100_000)) + "/999")
    out = urls.judge(pages(spark, us), labels(spark, marks))
    blocked = {r["page_id"] for r in out.where("verdict = 'block'").collect()}
    assert blocked >= set(range(10))  # by thousands of rules, which need not be without exception
