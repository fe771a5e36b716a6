"""The pipeline against plain versions of its stages."""

import random
import re

import public_tokenizers
import sentencepiece

import corpus_pipeline
from slotflow.llm import pii
from test_near import brute
from test_quality import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(160):
        words = rng.choices(vocab, k=rng.randint(40, 140))
        if i % 9 == 0:
            words[3:5] = [f"{rng.choice(vocab)}@mail.example.com", "patient"]  # a term that goes with its kind
        if i % 13 == 0:
            words = [w + "#" for w in words]
        rows.append([i, " ".join(words)])
        if i % 5 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append([1000 + i, " ".join(words)])
        if i % 8 == 0:
            rows.append([2000 + i, rows[-1][1]])
    rows += [[5000, None], [5001, ""], [5002, "too short"]]
    return [(d, t, rng.choice(["en", "de"]), rng.choice(["a", "b", "c"]), len(t or "")) for d, t in rows]


def test_stages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = step(spark, docs, "")
        if name != "encode":
            assert out.dtypes == docs.dtypes
        got = out.collect()
        if name == "quality":
            passed = {d for d, t in before.items() if not plain(t)[5]}
            symbols = {d for d in passed if "#" in before[d]}
            assert {r.doc_id for r in got} == passed - symbols and symbols
        elif name == "near_copies":
            assert {r.doc_id for r in got} == {c for _, c in brute(list(before.items()), 5, 80).values()} != set(before)
        elif name == "personal_data":
            spans = {d: [{"kind": pii.KINDS[k], "start": s, "end": e} for s, k, e in pii.find(t)] for d, t in before.items()}
            for d, t in before.items():
                spans[d] += [{"kind": "term-email", "start": m.start(), "end": m.end()} for m in re.finditer(r"\bpatient\b", t)]
            want = {d: pii.clean_text(t, spans[d]) for d, t in before.items()}
            assert {r.doc_id: r.text for r in got} == want != before and all(r.n_chars == len(r.text) for r in got)
            assert any("patient" in t for t in before.values()) and not any("patient" in r.text for r in got)
        elif name == "mix":
            assert {r.doc_id: r.text for r in got}.items() <= before.items()
            assert 0 < sum(len(r.text.split()) for r in got) <= 0.8 * sum(len(t.split()) for t in before.values())
        else:
            model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            assert sorted((r.doc_id, list(r.pieces)) for r in got) == sorted((r.doc_id, model.encode(r.text)) for r in docs.collect())
        docs = spark.createDataFrame(got, out.schema)


def test_run_equals_its_stages(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(tmp_path))
    key = lambda df: sorted((r.doc_id, list(r.pieces)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, str(tmp_path))) == key(docs)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
