"""Piece ids against the library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from slotflow.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(PATH)


def texts(seed):
    rng = random.Random(seed)
    out = [None, "", " ", "   ", "a", " a  b ", "\n", "a\n\nb", "x▁y", "日本語 テスト", "🙂 ok 🙂🙂", "1234567 3.14", "a" * 40, "x" * 3000, " " * 100, "<s> </s> <unk>", "\x00\x01 a\x02b", "ﬁ①"]
    out += ["".join(rng.choice("abcdeth innrs  \nEé1.") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    ranges = [(32, 126), (160, 0x24F), (0x370, 0x5FF), (0x4E00, 0x4EFF), (0x1F300, 0x1F5FF)]
    return out + ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 150))) for _ in range(150)]


def test_same_ids_as_the_library(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = texts(1)
    ids, bounds = pieces.Encoder(vocabulary).encode(rows)
    want = model.encode([t or "" for t in rows], num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert pieces.decode_ids(vocabulary, ids, bounds) == [(t or "").replace("▁", " ") for t in rows]


def test_small_index(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "INDEX_CHARS", 50)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = texts(2)[:120]
    ids, bounds = pieces.Encoder(vocabulary).encode(rows)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == model.encode([t or "" for t in rows])


def test_find_pieces_is_a_substring_search():
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    words = sorted({text[i : i + rng.randint(1, 50)] for i in range(0, 2900, 17)} | {"zz", "abz", text[-3:], text[:40]})
    which, start = pieces.find_pieces(codes, [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words])
    want = {(k, i) for k, w in enumerate(words) for i in range(len(text)) if text.startswith(w, i)}
    assert set(zip(which.tolist(), start.tolist())) == want and len(which) == len(want)


def test_documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(3)[:60])] + [(None, "no id", "y"), (1, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string").repartition(3)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = pieces.report(df, PATH).collect()
    assert sorted((r.doc_id or 0, list(r.pieces)) for r in got) == sorted((d or 0, model.encode(t or "")) for d, t, _ in rows)
    assert all(r.round_trip and r.n_pieces == len(r.pieces) for r in got)
    back = pieces.decode(pieces.encode(df, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((d or 0, (t or "").replace("▁", " ")) for d, t, _ in rows)
    assert pieces.report(df.limit(0), PATH).collect() == []
