"""The lattice of shapes against walking all documents in one go."""

import json
import random
from collections import Counter

from tests.test_archives import ANN, BOB
from tests.test_splittable import ODD
from threadloom.sources import shapes


def walk(x, place, out, parents):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number"}.get(type(x), "null")
    out.setdefault(place, Counter())[kind] += 1
    for key, v in x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ():
        below = f"{place}[]" if isinstance(x, list) else f"{place}.{key}" if key.replace("-", "_").isidentifier() else f"{place}[{json.dumps(key)}]"
        parents[below] = place if isinstance(x, dict) else None
        walk(v, below, out, parents)


def test_equal_to_one_walk_in_any_order(spark):
    rng = random.Random(1)
    values = [ANN, BOB, ODD, {}, [], 5, None, {"a": 1}, {"a": 2.5}, {"a": None}, {"a": "x"}, {"b": 1, "a b": {"c.d": [1, 2.0, None]}}, {"b": 7}, {"n": None}]
    raws = [json.dumps(v) for v in values] + ["{", "", None]
    out, parents, there = {}, {}, Counter()
    for v in values:
        own = {}
        walk(v, "$", own, parents)
        there.update(own.keys())
        for place, kinds in own.items():
            out.setdefault(place, Counter()).update(kinds)
    out["$"]["invalid"] += 2
    out["$"]["null"] += 1
    for seed, parts in ((0, 1), (1, 5)):
        rng.seed(seed)
        rng.shuffle(raws)
        got = {r["place"]: r for r in shapes.shapes(spark.createDataFrame([(r,) for r in raws], "raw string").repartition(parts)).collect()}
        assert {p: Counter(r["kinds"]) for p, r in got.items()} == out
        for place, r in got.items():
            real = set(out[place]) - {"null"}
            want = "null" if not real else "number" if real == {"integer", "number"} else real.copy().pop() if len(real) == 1 else None
            assert r["kind"] == want and r["conflict"] == (want is None) and r["n"] == sum(out[place].values()), place
            assert r["optional"] == (parents.get(place) is not None and r["n"] < out[parents[place]]["object"]), place
            assert place == "$" or r["documents"] <= there[place]
    assert got["$.a"]["conflict"] and got["$.b"]["kind"] == "integer" and got['$["a b"]["c.d"][]']["kind"] == "number"


def test_deep_and_empty(spark):
    deep = spark.createDataFrame([("[" * 100_000 + "]" * 100_000,), ('{"a":' * 200 + "1" + "}" * 200,)], "raw string")
    got = {r["place"]: r["kind"] for r in shapes.shapes(deep).collect()}
    assert got["$" + ".a" * 200] == "integer"
    assert shapes.shapes(deep.limit(0)).count() == 0
