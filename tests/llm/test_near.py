"""Near copies against a comparison of all pairs."""

import random
import re

import pytest

from slotflow.llm import near
from slotflow.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = {d: shingles(t, size) for d, t in rows}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def run(spark, rows, size, percent, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return [(r.doc_id, (r.n_shingles, r.component_id)) for r in near.near_components(df, size, percent, **kw).collect()]


def corpus(seed, n_groups=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(n_groups):
        words = rng.choices(vocab, k=rng.choice([1, 2, 3, 6, 12, 40, 120, 300]))
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 20))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.2:
                words = copy  # drifting chains of copies
            rows.append((rng.randrange(10**6) * 1000 + doc, rng.choice([" ", "\n "]).join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
            doc += 1
    return rows


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 3, 90), (3, 5, 80)])
def test_against_all_pairs(spark, seed, size, percent):
    rows = corpus(seed)
    assert dict(run(spark, rows, size, percent)) == brute(rows, size, percent)


def test_large_regions_are_split(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(300)]
    words = rng.choices(vocab, k=120)
    rows = []
    for d in range(120):
        copy = list(words)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        if d % 40 == 0:
            words = copy
        rows.append((d, " ".join(copy)))
    want = brute(rows, 3, 90)
    assert len({c for _, c in want.values()}) > 3
    assert dict(run(spark, rows, 3, 90, max_region=10)) == want


@pytest.mark.parametrize("percent", [50, 67, 80, 90, 99])
def test_border_sizes(spark, percent):
    base = [f"x{i}" for i in range(60)]
    rows = []
    for n in (1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 20, 21, 30, 59, 60):
        rows.append((n, " ".join(base[:n])))
        rows.append((100 + n, " ".join(base[: n - 1] + ["y"])))
    assert dict(run(spark, rows, 1, percent)) == brute(rows, 1, percent)


def test_edge_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "A B C D"), (9, None), (8, ""), (7, " \n"), (None, "a b c d"), (1, "x"), (2, "X"), (4, "x y")]
    got = run(spark, rows, 3, 90)
    assert sorted(g for g in got if g[0] is not None) == [(1, (1, 1)), (2, (1, 1)), (3, (2, 3)), (4, (1, 4)), (5, (2, 3)), (5, (2, 3)), (7, (0, 7)), (8, (0, 8)), (9, (0, 9))]
    assert [g[1][0] for g in got if g[0] is None] == [2]
    empty = spark.createDataFrame([], "doc_id long, text string, region long, component_id long")
    assert near.near_components(empty).collect() == []


def test_keep_first_keeps_columns(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, None, None), (None, "a b c d e f", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = near.keep_first(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 3]


def test_folded_sets_bound_the_similarity():
    """The folded similarity is never below that of the sets, also across fold widths."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64))
        keep = a[rng.random(len(a)) < rng.choice([0.5, 0.8, 0.9, 1.0])]
        b = np.unique(np.concatenate((keep, rng.integers(0, 2**63, rng.integers(0, 90), dtype=np.uint64))))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        similar = 100 * common >= 60 * (len(a) + len(b) - common)
        label = near.check_meeting(np.array([len(a), len(b)]), [near.fold_set(a), near.fold_set(b)], 60)
        assert not similar or label.tolist() == [0, 0]


def test_documents_that_share_a_passage_are_not_chained(spark):
    """At 80 percent such documents meet, but need no edges."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"{rng.randrange(10**9)}" for _ in range(rng.randint(60, 200))) + " " + passage) for i in range(80)]
    rows += [(100, rows[0][1] + " x"), (101, rows[5][1] + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    reps = df.select("doc_id")
    edges = {(r.a, r.b) for r in near.checked_edges(df, reps, 5, 80).distinct().collect()}
    assert edges == {(100, 0), (101, 5)}
    assert dict(run(spark, rows, 5, 80)) == brute(rows, 5, 80)


def plain_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "wide"])
def test_components_against_union_find(spark, monkeypatch, kind):
    """A long chain, a hub that holds most edges, 64-bit ids of either sign; self loops, repeats."""
    rng = random.Random(kind)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(280)],
        "chain": [(i, i + 1) for i in range(400)],
        "hub": [(0, i) for i in range(1, 1500)] + [(5000, i) for i in range(1400, 1600)] + [(-3, 0)],
        "wide": [(rng.randrange(-200, 200) * 2**55, rng.randrange(-200, 200) * 2**55) for _ in range(200)],
    }[kind] + [(7, 7), (9999, 9999)]
    df = spark.createDataFrame(edges + edges[:20] + [(None, 4), (4, None)], "a long, b long").repartition(5)
    got = components(df).collect()
    assert len({r.node for r in got}) == len(got)
    assert {r.node: r.root for r in got} == plain_components(edges)
    assert components(df.limit(0)).collect() == []


def test_frequent_sets_and_null_ids(spark):
    """Two thirds of all rows are copies of two texts; null ids get no component."""
    rows = [(i, f"{'x' if i % 3 else 'y'} b c d e f g") for i in range(600)] + [(None, "x b c d e f g"), (None, None), (700, ""), (701, None)]
    got = near.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: (1 if i % 3 else 0) for i in range(600)} | {700: 700, 701: 701}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None] and len(got) == len(rows)
