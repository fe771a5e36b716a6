"""Resampling against a plain version; sorting by regular sampling against sorted()."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from slotflow.llm import resampling


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def runs(text, k_max, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, k_max + 1) for i in range(len(w) - k + 1)]


def plain(rows, target, percent, min_words, k_max, buckets, seed=2024):
    s, t = Counter(b for _, x in rows for b in runs(x, k_max, buckets)), Counter(b for x in target for b in runs(x, k_max, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, x in rows:
        found = runs(x, k_max, buckets)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(x)), len(found), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[0] is not None and r[1] >= min_words), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = rank
    return sorted(map(str, map(tuple, out)))


def table(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "cat", "É1", "sat", "x9", "日本", "a_b", "on", "Mat", "z"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(700)]
    return rows + [(-1, None), (-2, ""), (None, "the cat " * 30), (7, "cat " * 25), (7, "cat " * 25), (9, "Word" * 500_000 + " a" * 900_000), (10, "-\x00_")]


@pytest.mark.parametrize("k_max,percent,min_words,buckets", [(1, 10, 20, 10_000), (2, 37, 5, 64), (3, 100, 0, 1000)])
def test_against_a_plain_version(spark, monkeypatch, k_max, percent, min_words, buckets):
    monkeypatch.setattr(resampling, "RUN", 50)
    target = ["the mat sat", "日本 z z z", None, ""]
    rows = table(k_max)
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, score int").repartition(6)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    got = resampling.resample(df, goal, percent, min_words, k_max, buckets)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, target, percent, min_words, k_max, buckets)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resampling.report(docs, goal).collect() == []
    some = spark.createDataFrame([(i, "a b c " * 10) for i in range(30)], "doc_id long, text string")
    assert sorted(r["rank"] for r in resampling.report(some, goal.limit(0)).collect() if r["rank"]) == [1, 2, 3]


def test_stretches_do_not_change_features(monkeypatch):
    text = (" ".join(f"w{i % 97}" for i in range(4000)) + " " + "q" * 300).encode()
    whole = [np.sort(np.concatenate([resampling.features(w, s, k, 1000) for w, s in resampling.word_lists(text, k)])) for k in (1, 2, 4)]
    monkeypatch.setattr(resampling, "STRETCH", 50)
    for k, want in zip((1, 2, 4), whole):
        parts = list(resampling.word_lists(text, k))
        assert len(parts) > 50
        assert np.array_equal(np.sort(np.concatenate([resampling.features(w, s, k, 1000) for w, s in parts])), want)


def test_exact_ranks_with_ties(spark):
    """Few different scores and ids, a third of the rows equal: ranks are 1 to the number drawn."""
    rng = random.Random(4)
    rows = [(5, 1, 1, 0, 10) if k % 3 == 0 else (rng.randint(0, 20), 1, 1, rng.randint(0, 2), rng.randint(0, 9)) for k in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in resampling.COLUMNS)).repartition(7)
    got = resampling.top_ranks(df, 1700, 3000).collect()
    by_rank = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in by_rank] == list(range(1, 1701)) and len(got) == 3000
    want = sorted(rows, key=lambda r: (-r[4], r[0], r[2], r[3], r[1]))
    assert [tuple(r)[:5] for r in by_rank] == want[:1700]
    assert sorted(tuple(r)[:5] for r in got) == sorted(rows)
