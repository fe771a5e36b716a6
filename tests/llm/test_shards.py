"""Binary token shards: the perfect hash, the ids against the library, access by key, reruns."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from slotflow.llm import encoding, shards
from slotflow.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    return lambda text: t.encode(text, add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(5)
    out = [None, "", " ", "\n\n", "Hello  World's\x0b\x0c!", "É́ é ΟΔΟΣ Σ", "<|endoftext|> a<|startoftext|>", "日本語 テスト🙂", "\x1c\x1d a\x85b　c d\xa0e", "don't we'll I'M 123", " ́a", "İstanbul ǅ ﬁ"]
    planes = [(32, 127), (128, 0x24F), (0x300, 0x52F), (0x600, 0x9FF), (0x1100, 0x11FF), (0x2000, 0x206F), (0x3040, 0x30FF), (0xAC00, 0xAD00), (0x1F300, 0x1F6FF), (9, 33)]
    return out + ["".join(chr(rng.randint(*rng.choice(planes))) for _ in range(rng.randint(1, 60))) for _ in range(1500)]


def test_ids_are_the_librarys(library):
    own = encoding.encoder(PATH)
    bad = [t for t in odd_texts() if t is not None and np.frombuffer(own.ids(t), "<u4").tolist() != library(t)]
    assert bad == []


def test_code_points_of_all_scripts(library):
    own = encoding.encoder(PATH)
    for low in [*range(0, 0x20000, 256), *range(0xE0000, 0xE0200, 256)]:
        points = [chr(c) for c in range(low, low + 256) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}1{c} " for c in points)
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library(text), hex(low)


def test_long_texts_in_stretches(library, monkeypatch):
    monkeypatch.setattr(encoding, "STRETCH", 100)
    monkeypatch.setattr(encoding, "MEMO", 20)
    own, byte_level = encoding.Encoder(PATH), encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    for _ in range(50):
        text = "".join(rng.choice(["word", "Other", " ", "  ", "\n", " \t", "é", "12", ", ", "\xa0", "x" * 150]) for _ in range(400))
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library(text)
        assert np.frombuffer(byte_level.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    table = shards.PerfectHash.build(keys)
    assert np.array_equal(np.sort(table.slots(keys)), np.arange(len(keys)))


def test_keys_that_no_level_places(monkeypatch):
    monkeypatch.setattr(shards, "LEVELS", 1)
    keys = np.arange(500, dtype=np.uint64) * 7
    table = shards.PerfectHash.build(keys)
    assert len(table.rest) and np.array_equal(np.sort(table.slots(keys)), np.arange(500))
    assert (table.slots(keys + np.uint64(1)) < 500).all()


def expected(rows, library):
    """Ascending doc_id; rows of one doc_id in any order, as only their texts' digests order them."""
    out, start = {}, 0
    for i, t in rows:
        ids = [*library(t or ""), 1]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("limit", [256, 4 << 20])
def test_files_read_back(spark, library, limit):
    rows = [(i * 3 - 600, t) for i, t in enumerate(odd_texts()[:400])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    folder = scratch_path(spark, "shards")
    got = {r.doc_id: tuple(r)[1:] for r in shards.report(df, PATH, folder, limit).collect()}
    assert got == expected(sorted(rows), library)
    files = shards.shards_of(spark, folder)
    assert (files.count() > 50) == (limit == 256)
    # access by key: rows that are there, and none for those that are not
    want = dict(rows)
    found = {r.doc_id: r for r in shards.lookup(spark, folder, [-600, 0, 300, 1, 2, 10**15, -(2**62)]).collect()}
    assert sorted(found) == [-600, 0, 300]
    assert all(r.ids == [*library(want[k] or ""), 1] and r.start == got[k][0] for k, r in found.items())
    # a task that runs again changes nothing
    names = sorted(f for f in os.listdir(f"{folder}/ids") if not f.startswith("."))
    assert not [f for f in names if f.startswith("_")] and len(names) == files.count()


def test_repeated_and_null_keys(spark, library):
    rows = [(7, "b b"), (7, "b b"), (7, "a"), (None, "null key"), (None, None), (3, "c"), (2**62, "far")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_path(spark, "shards")
    got = shards.report(df, PATH, folder).collect()
    crc = lambda t: zlib.crc32(np.array([*library(t or ""), 1], "<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(i), crc(t)) for i, t in rows)
    spans = sorted((r.start, r.start + r.n_tokens, -1 if r.doc_id is None else r.doc_id) for r in got)
    assert [a for a, _, _ in spans] == [0, *(b for _, b, _ in spans[:-1])] and [k for _, _, k in spans] == sorted(k for _, _, k in spans)
    assert len(shards.lookup(spark, folder, [7]).collect()) == 3
    empty = scratch_path(spark, "shards")
    assert shards.report(df.limit(0), PATH, empty).collect() == [] and shards.lookup(spark, empty, [7]).collect() == []


def test_one_file_as_bytes():
    ids = np.array([70000, 1, 5, 1, 6, 1], "<u4").tobytes()
    shard = shards.Shard(shards.pack_shard(2, 10, [None, 4, 9], [2, 4, 6], ids, 4))
    assert [x.tolist() for x in shard.get(9)] == [[6, 1]] and shard.get(5) == [] and shard.n_null == 1
    with pytest.raises(ValueError):
        shards.Shard(b"x" * 200)
