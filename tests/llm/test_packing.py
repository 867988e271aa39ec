import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from threadloom.llm import packing


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(packing.tokenizer_path())
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path())


def test_encoder_equals_tokenizers(encoder, reference, edge_rows):
    rng = random.Random(2)
    texts = [t or "" for _, t in edge_rows]
    texts += [x for c in range(0x250) for x in (chr(c), f"a{chr(c)}b", f" {chr(c)}{chr(c)} 1", f"{chr(c)}\n x")]
    texts += ["<|endoftext|> it's we'll I'M  'S", "日本語のテキスト 漢字", "Привет мир", "🙂🙂 ok", "a b　c", "x" * 3000, " " * 500 + "y"]
    texts += ["".join(chr(rng.randrange(1, 0x250)) for _ in range(200)) for _ in range(300)]
    for t in texts:
        assert encoder.ids(t).tolist() == reference.encode(t, add_special_tokens=False).ids, repr(t[:40])


def test_a_million_of_a_kind_are_encoded(encoder, reference):
    for run in (" ", "\n", "\t", "a", "7", ".", "é", "b.", "a-", " x", "\n ", "<", '"', "日"):
        for text in (run * (1_000_000 // len(run)), run * 2000 + " end", "so" + run * 999 + "a"):
            assert encoder.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids, repr(run)


def check(rows, window):
    of, seqs = {}, {}
    for r in rows:
        of.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
    return of, seqs


def test_pieces_rebuild_every_document(edge, edge_rows, reference):
    rows = packing.pack(edge, keep_ids=True).collect()
    check(rows, 1024)
    got = {}
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        got.setdefault(r["doc_id"], []).append((r["start"], tuple(r["ids"])))
    want = {}
    for d, t in edge_rows:
        ids = (*reference.encode(t or "", add_special_tokens=False).ids, 0)
        for a in range(0, len(ids), 1024):
            want.setdefault(d, []).append((a, ids[a : a + 1024]))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_padding_is_small_and_groups_agree(edge):
    rows = packing.pack(edge).collect()
    _, seqs = check(rows, 1024)
    tokens = sum(r["length"] for r in rows)
    assert len(seqs) <= -(-tokens // 1024) * 1.02 + 1
    _, many = check(packing.pack(edge, group_rows=8).collect(), 1024)
    assert len(many) >= len(seqs)


def test_best_fit_picks_the_tightest_window():
    rng = random.Random(8)
    lengths = sorted((rng.randint(1, 100) for _ in range(400)), reverse=True)
    into, offsets = packing.best_fit_decreasing(lengths, 100)
    room, want = [], []
    for n in lengths:
        fit = [(left, i) for i, left in enumerate(room) if left >= n]
        best = min(x[0] for x in fit) if fit else None
        if best is None:
            room.append(100)
            best = 100
        i = into[len(want)]
        assert room[i] == best and offsets[len(want)] == 100 - best
        room[i] -= n
        want.append(i)


def test_empty(nothing):
    assert packing.pack(nothing).count() == 0


def test_equal_and_null_rows_fill_no_group(spark):
    docs = spark.sql("SELECT CASE WHEN id < 4000 THEN NULL ELSE 5L END AS doc_id, CASE WHEN id < 4000 THEN NULL ELSE 'the same text' END AS text FROM range(8000)")
    rows = packing.pack(docs, group_rows=50).collect()
    groups = {}
    for r in rows:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + 1
    assert len(rows) == 8000 and len(groups) >= 150 and max(groups.values()) <= 100


def test_full_windows_go_through_no_group(spark):
    docs = spark.createDataFrame([(1, "word " * 9000), (1, "word " * 9000), (2, "a")], "doc_id long, text string")
    rows = packing.pack(docs, window=64, group_rows=4).collect()
    check(rows, 64)
    full = [r["sequence_id"] for r in rows if r["length"] == 64]
    assert len(set(full)) == len(full) > 200 and min(full) >= 1 << 62 and max(r["sequence_id"] for r in rows if r["length"] < 64) < 1 << 62
