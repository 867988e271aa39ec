"""Merging, tails and split reading from the command line."""

import json

from tests.test_archives import ANN, BOB, post
from threadloom import cli


def test_merge_and_others(spark, tmp_path):
    old, new = tmp_path / "old", tmp_path / "new"
    for folder, ann in ((old, ANN), (new, ANN | {"tweets": ANN["tweets"][1:] + [post("900", "later")], "_metadata": {"size": "6", "etag": "n", "local_x": "2"}})):
        folder.mkdir()
        (folder / "ann_archive.json").write_text(json.dumps(ann))
    (new / "bob_archive.json").write_text(json.dumps(BOB))
    assert cli.main(["merge", str(old), str(tmp_path / "out"), "--with", str(new)]) == 0
    rows = spark.read.parquet(str(tmp_path / "out" / "tweets"))
    ids = sorted((r["archive_file"][:3], r["tweet_type"], r["id"]) for r in rows.collect())
    assert ("ann", "tweet", "100") in ids and ("ann", "tweet", "900") in ids and ("bob", "tweet", "300") in ids and len(set(ids)) == len(ids)
    stats = {r["tweet_type"]: (r["old"], r["new"], r["merged"]) for r in spark.read.parquet(str(tmp_path / "out" / "stats")).collect()}
    assert stats["tweet"] == (2, 4, 5)
    meta = {r["archive_file"]: r["metadata"] for r in spark.read.parquet(str(tmp_path / "out" / "metadata")).collect()}
    assert meta["ann_archive.json"] == {"size": "6", "etag": "n", "local_x": "1"}
    assert cli.main(["tails", str(new), str(tmp_path / "tails")]) == 0
    assert spark.read.parquet(str(tmp_path / "tails")).where("metadata is not null").count() == 1
    for extra in ([], ["--split"]):
        assert cli.main(["build", str(new), str(tmp_path / f"build{len(extra)}"), *extra]) == 0
    a, b = (sorted(map(repr, spark.read.parquet(str(tmp_path / f"build{k}")).collect())) for k in (0, 1))
    assert a == b
