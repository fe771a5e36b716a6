"""Fill-in-middle against a plain version, and exact round trips."""

import hashlib
import random
import re

import pytest

from slotflow.llm import infill


def plain(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate or doc_id is None:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    out = [None, "", "\n", "a", "a\n", "\n\n", "a\n\nb", "<P>", "x <S> y", "<M", "P>\n<", "<\nP>\n", "<P\n>", "é\n日本\r\n🙂", "\x00\n\x85\n x", "a\n" * 5000, "long line " * 3000]
    return out + ["".join(rng.choice("ab\n<>PSMé🙂") for _ in range(rng.randint(1, 60))) for _ in range(600)]


@pytest.mark.parametrize("block", [7, 1 << 21])
@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (100, 100)])
def test_outputs_and_round_trip(spark, monkeypatch, block, rate, spm):
    import pyarrow as pa

    monkeypatch.setattr(infill, "BLOCK", block)
    rows = list(enumerate(texts())) + [(None, "a\nb"), (5, "a\nb\nc"), (5, "a\nb\nc"), (-3, "x\ny")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["doc_id", "text"])
    done = list(infill._restore(infill._transform(iter([batch, batch.slice(0, 0)]), 7, rate, spm)))
    got = [r for b in done for r in b.to_pylist()]
    assert [(r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got] == [plain(i, t, 7, rate, spm) for i, t in rows]
    assert [r["restored"] for r in got] == [t or "" for _, t in rows]


def test_in_spark(spark):
    rows = list(enumerate(texts())) + [(None, "a\nb"), (5, "a\nb\nc"), (5, "a\nb\nc")]
    df = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], "doc_id long, text string, n long, output int, restored string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = sorted(str((i, *plain(i, t)[:4], sha(plain(i, t)[4]), sha(t or ""))) for i, t in rows)
    assert sorted(str(tuple(r)) for r in infill.report(df).collect()) == want
    assert infill.report(df.limit(0)).collect() == []


def test_restored_from_output_and_form_alone(spark):
    df = spark.createDataFrame([("<S>c<P>a\n<M>b\n", "spm", "k"), ("<P>a\n<S>c<M>b\n", "psm", "k"), ("<P>", "plain", None)], "output string, form string, doc_id string")
    assert [r.restored for r in infill.restore(df).collect()] == ["a\nb\nc", "a\nb\nc", "<P>"]
