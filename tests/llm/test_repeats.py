"""Repeated windows against a plain scan of all windows."""

import hashlib
import random
import re

import pytest

from slotflow.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """{doc_id: (n_words, n_removed, kept)} for rows with distinct, non-null doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows)):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out[doc_id] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.digest(repeats.remove_repeats(df, **kw)).collect()
    return [(r.doc_id, (r.n_words, r.n_removed, r.kept_sha256)) for r in got]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_with_shared_passages(spark, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(40)]
    passages = [" ".join(rng.choices(vocab, k=rng.randint(18, 60))) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocab, k=rng.randint(0, 40))))
        rows.append((d * 7 - 100, rng.choice([" ", "\n", "\t "]).join(parts)))
    assert dict(run(spark, rows)) == brute(rows)


def test_runs_and_periods(spark):
    rows = [(1, "a " * 50), (2, "a " * 19), (3, "a b " * 30), (4, "b a " * 11 + "c " * 70), (5, "a " * 20 + "x"), (6, "x " + "a " * 30)]
    assert dict(run(spark, rows)) == brute(rows)


def test_edge_rows(spark):
    text = " ".join(f"t{i}" for i in range(25))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, text), (4, text), (5, text + "\x1c  end"), (None, text), (6, "one")]
    got = run(spark, rows)
    want = brute([r for r in rows if r[0] is not None])
    assert sorted((d, g) for d, g in got if d is not None) == sorted([*want.items(), (4, want[4])])
    assert [g[1] for d, g in got if d is None] == [0]
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string, marks string")).collect() == []


def test_other_windows_and_one_long_text(spark):
    rng = random.Random(5)
    long_text = " ".join(rng.choices([f"w{i}" for i in range(3000)], k=150_000))
    rows = [(3, long_text), (1, " ".join(long_text.split()[70_000:70_100])), (2, "short")]
    assert dict(run(spark, rows, window=8, rounds=1)) == brute(rows, 8)
