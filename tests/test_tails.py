"""Metadata from the last bytes of archives."""

import io
import json
import random

from threadloom.sources import archives, tails
from tests.test_splittable import ODD


def value(text, block, most=1 << 20):
    data = text.encode()
    raw, n = tails.read_tail(lambda: io.BytesIO(data), len(data), block, most)
    assert n <= min(len(data), most)
    return None if raw is None else json.loads(raw)


def test_every_block_size():
    rng = random.Random(3)
    metas = [{"size": "1"}, {}, {"a": {"b": ["}", "]", '"', "\\", {"_metadata": {"x": 1}}]}}, None, 5, "te}xt \\\" ", [1, {"c": "{"}], {"note": 'says "_metadata": {} \\'}]
    for meta in metas:
        body = {"tweets": [{"tweet": {"full_text": '"_metadata": {"no": 1}' + "\\" * rng.randint(0, 5)}, "_metadata": {"inner": 1}} for _ in range(5)]}
        for text in (json.dumps(body | {"_metadata": meta}), json.dumps(body | {"_metadata": meta}, indent=2) + " \n", json.dumps({"_metadata": meta} | body), json.dumps({"a": 1, "_metadata": meta, "z": "},"})):
            for block in (1, 2, 3, 7, 50, 10_000):
                assert value(text, block) == meta, (text, block)


def test_no_metadata():
    for text in ("", " ", "[]", "{}", "5", '{"a": {"_metadata": 1}}', '{"a": "\\"_metadata\\": 1}"}', '{"tweets": [', '"_metadata": 1', json.dumps(ODD)[:-1]):
        for block in (1, 4, 1000):
            assert value(text, block) is None
    far = json.dumps({"_metadata": {"a": 1}, "x": "y" * 5000})
    assert value(far, 16, most=1000) is None and value(far, 16) == {"a": 1}


def test_bytes_read_do_not_follow_the_size(spark, tmp_path):
    for name, n in (("small", 10), ("large", 300_000)):
        (tmp_path / f"{name}_archive.json").write_text(json.dumps({"tweets": [{"tweet": {"id_str": str(i)}} for i in range(n)], "_metadata": {"n": n, "s": "ü"}}))
    (tmp_path / "none_archive.json").write_text(json.dumps(ODD | {"_metadata": None}))
    got = {r["archive_file"]: r for r in tails.archive_tails(spark, str(tmp_path)).collect()}
    assert got["large_archive.json"]["file_size"] > 5_000_000 and got["large_archive.json"]["bytes_read"] == tails.BLOCK
    plain = {r["archive_file"]: r["metadata"] for r in archives.archive_metadata(archives.read_archives(spark, str(tmp_path))).collect()}
    assert {k: r["metadata"] for k, r in got.items() if r["metadata"]} == plain and len(plain) == 2
