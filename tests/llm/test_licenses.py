import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from threadloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


RULES = [r | {"regex": regex.compile(r["regex"], regex.A)} for r in licenses.rules()]  # more than any cache of patterns holds


def low(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def slow(t):
    t = low(t)
    w = WORD.findall(t)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    found, flat = [], re.sub(r"[ \t\n\x0b\f\r]+", " ", t)
    for r in RULES:
        if r["keyword"] in flat:
            found += [(r["priority"], r["label"], r["confidence"], m.start(), m.end()) for m in r["regex"].finditer(t)]
    kept = [d for d in found if not any(h[0] < d[0] and h[3] <= d[3] and h[4] >= d[4] for h in found)]
    score = max([0.5 if places else 0.0, *(d[2] for d in kept)])
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | {d[1] for d in kept})), score


CASES = [
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0.",
    "SPDX-License-Identifier: GPL-3.0-only", "under the GNU Lesser General\nPublic License, version 2.1 or the Apache\n License", "CC BY, cc-by; cc by cc by", "all rights reserved general public license", "CC0 1.0 Universal and the public domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "no such thing here", "unmit license", "Copyright (c) 2020 X. All Rights Reserved.", "MIT License " * 40, "CREATIVE COMMONS Attribution-ShareAlike", None, "", "é general public licenseé",
]


def test_matches_brute_force(spark, edge_rows):
    rows = list(enumerate(CASES)) + [(100 + i, t) for i, (_, t) in enumerate(edge_rows)]
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.digest(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, t in rows:
        assert got[i] == slow(t), (t or "")[:60]


def test_rules_are_many_ordered_and_gated():
    rules = licenses.rules()
    assert len(rules) > 400 and [r["priority"] for r in rules] == sorted(r["priority"] for r in rules)
    for r in rules:
        assert any(a in r["keyword"] for a in licenses.ANCHORS), r["keyword"]
        regex.compile(r["regex"])


def test_specific_beats_general(spark):
    df = spark.createDataFrame([(1, "Licensed under the GNU Affero General Public License, version 3")], "doc_id long, text string")
    d = licenses.scan(df).select(F.explode("detections").alias("d")).select("d.label").collect()
    assert [r["label"] for r in d] == ["agpl-3.0"]


def test_edges_and_native_plan(edge, nothing):
    out = licenses.digest(licenses.scan(edge))
    assert out.count() == edge.count() and licenses.digest(licenses.scan(nothing)).count() == 0
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert prose is not None


def test_thousands_of_places_and_long_runs(spark):
    texts = ["Licensed under the MIT License, GPLv3 or CC BY-SA 4.0. " * 1500, "gpl-3.0 " * 3000 + "x", "cc by " * 2000]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.digest(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[0][5] == "cc-by,cc-by-sa-4.0,gpl-3.0,mit" and got[0][1] == 1500 and got[2][1] == 2000
    assert got[1] == slow(texts[1])
    runs = [x * n for x, n in ((" ", 10**6), ("\n", 10**6), ("a", 10**6), ("7", 10**6), ("b.", 300_000), ("<", 10**6), ('"', 10**6), ("a-", 300_000), ("licensed ", 30_000), ("copyright", 30_000), ("copyright ", 30_000), ("under the ", 30_000))]
    assert licenses.digest(licenses.scan(spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string"))).count() == len(runs)


@pytest.mark.parametrize("blank", ["\n", " ", "\n# "])
def test_blanks_around_a_keyword(spark, blank):
    """As without them, and in a few seconds: before, inside and behind a hit."""
    run = blank * (300_000 // len(blank))
    few = blank * 3
    forms = ["{0}mit license", "mit license{0}", "released under{0}the mit license", "mit{0}license", "license:{0}mit", "x{0}license: mit", "spdx-license-identifier:{0}mit", "{0}all rights reserved{0}copyright{0}licensed under{0}"]
    began = time.perf_counter()
    long, short = ([tuple(r)[1:] for r in licenses.digest(licenses.scan(spark.createDataFrame(list(enumerate(f.format(x) for f in forms)), "doc_id long, text string"))).orderBy("doc_id").collect()] for x in (run, few))
    assert time.perf_counter() - began < 90
    assert long == short == [slow(f.format(few)) for f in forms]


def test_operands_of_an_expression(spark):
    cases = {
        "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit", "SPDX-License-Identifier: MIT AND (ISC OR BSD-3-Clause)": "bsd-3-clause,isc,mit",
        "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MPL-2.0": "gpl-2.0,mpl-2.0", "SPDX-License-Identifier: MIT\nand isc": "mit", "this or mit": "",
    }
    got = licenses.digest(licenses.scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == list(cases.values()) == [slow(t)[5] for t in cases]
