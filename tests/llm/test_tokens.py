"""Token counts against the general library, and the cache."""

import random

import public_tokenizers
import sentencepiece
import tokenizers

from slotflow.llm import encoding, tokens
from slotflow.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    t = tokenizers.Tokenizer.from_file(PATH)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_counts_on_odd_texts():
    rng = random.Random(1)
    texts = ["", " ", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", "don't  we'll\n\n\t x", "\x00\x01", "a" * 3000, "日本語 🙂"]
    planes = [(32, 127), (128, 0x24F), (0x300, 0x52F), (0x600, 0x9FF), (0x2000, 0x206F), (0x3040, 0x30FF), (0x4E00, 0x4F00), (0x1F300, 0x1F6FF), (9, 14)]
    for _ in range(1500):
        texts.append("".join(chr(rng.randint(*rng.choice(planes))) for _ in range(rng.randint(1, 80))))
    count = encoding.encoder(PATH).count
    assert [count(t) for t in texts] == library(texts)


def test_code_points_of_all_scripts_are_split_alike():
    count = encoding.encoder(PATH).count
    texts = []
    for low in [*range(0, 0x20000, 64), *range(0xE0000, 0xE0200, 64)]:
        points = [chr(c) for c in range(low, low + 64) if not 0xD800 <= c < 0xE000]
        texts.append("".join(f"a{c}b {c}1{c} " for c in points))
    got, want = [count(t) for t in texts], library(texts)
    assert [i for i in range(len(texts)) if got[i] != want[i]] == []


def test_long_runs_through_the_query(spark):
    """10^6 of each white-space character, of a letter and of a digit, as the library counts them."""
    runs = [c * 1_000_000 for c in " \t\n\r\x0b\x0c\x85\xa0\u2028\u3000"] + ["a" * 1_000_000, "7" * 1_000_000, "ab " * 700_000, " \n" * 600_000 + "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "doc_id long, text string")
    cache = scratch_path(spark, "cache")
    tokens.create_cache(spark, cache)
    got = {r.doc_id: r.n_tokens for r in tokens.report(df, PATH, cache).collect()}
    assert [got[i] for i in range(len(runs))] == library(runs)


def test_frequent_digests(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cache = scratch_path(spark, "cache")
    tokens.create_cache(spark, cache)
    got = {r.doc_id: r.n_tokens for r in tokens.report(df, PATH, cache).collect()}
    assert got == dict(zip(range(400), library([t for _, t in rows])))


def test_special_tokens_between_runs_of_spaces():
    texts = ["a  <|endoftext|>  b", "  <|endoftext|>", "<|endoftext|>\n\n b   "]
    count = encoding.encoder(PATH).count
    assert [count(t) for t in texts] == library(texts)


def test_documents_and_cache(spark):
    rows = [(1, "hello world"), (2, "hello world"), (2, "hello world"), (3, None), (4, ""), (5, "other " * 1100), (None, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cache = scratch_path(spark, "cache")
    tokens.create_cache(spark, cache)
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.report(df, PATH, cache).collect()))
    want = sorted((d or 0, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(rows, library([t or "" for _, t in rows])))
    assert got == want
    stored = tokens.read_cache(spark, cache)
    assert stored.count() == 4  # hello world, '', other..., é
    # a second run encodes nothing that is stored, whatever the stored count says
    wrong = scratch_path(spark, "cache")
    stored.selectExpr("digest", "n_tokens + 100 AS n_tokens", "version").write.parquet(wrong)
    more = df.unionByName(spark.createDataFrame([(9, "new")], df.schema))
    again = {r.doc_id: r.n_tokens for r in tokens.count_tokens(more, PATH, wrong).collect()}
    assert again[1] == 102 and again[9] == 1
    assert tokens.read_cache(spark, wrong).count() == 5
    # another tokenizer's counts do not answer
    spm = public_tokenizers.path("piece_bpe_32k.model")
    pieces = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, spm, wrong).collect()}
    assert pieces[1] == len(sentencepiece.SentencePieceProcessor(model_file=spm).encode("hello world"))
    assert tokens.report(df.limit(0), PATH, cache).collect() == []


def test_general_file(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    assert [encoding.encoder(path).count(x) for x in ("Hello World", "")] == [len(t.encode(x, add_special_tokens=False).ids) for x in ("Hello World", "")]
