"""The splittable reader against the plain one, however files are cut."""

import json
import random

import pytest

from tests.test_archives import ANN, BOB, post
from threadloom.sources import archives, splittable

ODD = {
    "account": [{"account": {"username": "o}d{d", "accountId": "9"}}],
    "profile": [{"profile": {"description": {"bio": 'null, null "}]{[\\" \\\\'}, "userName": "odd"}}],
    "tweets": [post(str(i), f'{{"tweets": [{i}]}} \\" }}]}} \\\\ é😀 "quoted" \n\t' * (i % 5)) for i in range(40)] + [None, {"tweet": None}, {}],
    "other": [{"tweet": {"id_str": "not a section"}}, {"like": {"tweetId": "x"}}],
    "nested": {"tweets": [{"tweet": {"id_str": "too deep"}}], "a}b": {"c": [{"d": "}"}]}},
    "like": [{"like": {"tWeetId": str(i), "fullText": "}" * (i % 7) + "\\" * (i % 3)}} for i in range(30)],
    "note-tweet": {"noteTweet": {"noteTweetId": "no list"}},
    "community-tweet": [],
    "_metadata": {"size": "7", "merge_stats": {"a": {"b": "}"}}},
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    p = tmp_path_factory.mktemp("split")
    whole = json.dumps(ANN)
    files = {
        "ann": whole, "bob": json.dumps(BOB, indent=2) + "\n \n", "odd": json.dumps(ODD, ensure_ascii=False), "odd2": json.dumps(ODD, indent=1), "none": "{}", "empty": "",
        "cut": whole[:-1], "cut2": whole[: len(whole) // 2], "bad": '{"tweets": [', "list": "[1]", "number": "5", "two": "{}{}", "tail": whole + "}", "late": whole + " x",
        "entry": '{"tweets": [{"tweet": {"id_str": "1"}}, {"tweet": {"id_str": }}]}', "kinds": '{"tweets": [{"tweet": ]}}', "again": '{"tweets": [{"tweet": {"id_str": "1"}}], "tweets": []}',
        "open": '{"tweets": [{"tweet": {"id_str": "1"}}], "x": "}', "escape": '{"twe\\u0065ts": [{"tweet": {"id_str": "77"}}], "like": [{"like": {"tweetId": "78"}}]}',
    }
    (p / "sub").mkdir()
    for name, text in files.items():
        (p / f"{name}_archive.json").write_text(text, encoding="utf-8")
    (p / "sub" / "ann_archive.json").write_text(json.dumps(BOB))
    return str(p)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("chunk,split", [(1 << 20, "128m"), (300, "1k"), (1, "5k")])
def test_equal_to_the_plain_reader(spark, folder, chunk, split):
    plain = archives.read_archives(spark, folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = splittable.read(spark, folder, chunk_bytes=chunk)
        named = lambda df: sorted((r["archive_file"], r["corrupt"]) for r in df.collect())
        assert named(found.archives) == [x for x in named(plain) if x[0] != "empty_archive.json"]
        assert rows(splittable.source_tweets(found)) == rows(archives.source_tweets(plain))
        assert rows(archives.accounts(found.archives)) == rows(archives.accounts(plain))
        meta = lambda df: sorted((r["archive_file"], json.dumps(json.loads(r["metadata"]))) for r in archives.archive_metadata(df.where("not corrupt")).collect())
        assert meta(found.archives) == meta(plain)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_start_gives_the_same_entries():
    rng = random.Random(1)
    text = json.dumps(ODD, ensure_ascii=False).encode()
    whole, rest = splittable.cut(text, 0, 0, "")
    assert {r for r, _, _ in whole} == {"entry"} and [s for _, s, _ in whole].count("like") == 30
    assert json.loads(rest)["tweets"] == [None, None, None] and json.loads(rest)["like"] == [None]
    ends = [i + 1 for i, b in enumerate(text) if b == 125]
    for _ in range(200):
        cuts = [0, *sorted(rng.sample(ends[:-1], rng.randint(1, 12))), len(text)]
        inside, depth, section, pieces, left = 0, 0, "", [], b""
        for a, b in zip(cuts, cuts[1:], strict=False):
            data = text[a:b]
            found, part = splittable.cut(data, inside, depth, section)
            pieces += found
            left += part
            quotes, out, within = splittable._summary(data)
            last = splittable.last_section(data, inside, depth)
            section = section if last is None else last
            inside, depth = (inside + quotes) % 2, depth + (within if inside else out)
        merged = []
        for role, name, part in pieces:
            if role in ("entry", "head"):
                merged.append((name, part))
            else:
                merged[-1] = (merged[-1][0], merged[-1][1] + part)
        assert merged == [(s, t) for _, s, t in whole] and (inside, depth) == (0, 0)
        assert {k: v for k, v in json.loads(left).items() if k not in splittable.CUT} == {k: v for k, v in json.loads(rest).items() if k not in splittable.CUT}


def test_entries_of_other_kinds_stop_nothing(spark, tmp_path):
    (tmp_path / "x_archive.json").write_text('{"tweets": [5, {"tweet": {"id_str": "1"}}, "text }", [], [{"tweet": {"id_str": "no"}}], {"tweet": {"id_str": "2"}}], "like": {"like": {}}}')
    found = splittable.read(spark, str(tmp_path))
    assert [r["corrupt"] for r in found.archives.collect()] == [False]
    assert sorted(r["id"] for r in splittable.source_tweets(found).collect()) == ["1", "2"]


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    n = 60_000
    with (tmp_path / "big_archive.json").open("w") as f:  # one line of some 20 MB
        f.write('{"account": [{"account": {"username": "big"}}], "tweets": [')
        f.write(", ".join(json.dumps(post(str(i), f"text {i} }} {{ " + "x" * 120)) for i in range(n)))
        f.write(']}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        found = splittable.read(spark, str(tmp_path))
        chunks = splittable._chunks(spark, str(tmp_path), "*_archive.json", None, 1 << 20)
        assert chunks.select("start").distinct().count() >= 8 and chunks.rdd.getNumPartitions() >= 4
        got = splittable.source_tweets(found)
        assert got.count() == n and got.selectExpr("count(distinct id)").first()[0] == n
        assert got.where("full_text = concat('text ', id, ' } { ', repeat('x', 120)) and user_screen_name = 'big'").count() == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
