"""Nearest neighbours against all distances: recall, ranks and scores."""

import numpy as np
import pytest

from slotflow.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string").repartition(3)


def brute(vectors, query_ids, k):
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids], dtype=np.float64)
    norm = np.sqrt((m * m).sum(1))
    out = {}
    for q in query_ids:
        v = vectors[q].astype(np.float64)
        score = (m * v).sum(1) / (norm * np.sqrt((v * v).sum()))
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_and_scores(spark, clustered):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((12, 32)) * (3 if clustered else 0)
    vectors = {i: (centers[i % 12] + rng.standard_normal(32)).astype(np.float32) for i in range(3000)}
    df = frame(spark, [(i, v.tolist(), "x") for i, v in vectors.items()])
    got = ann.nearest(df, "vec_id % 50 = 0", k=5, cell_rows=500).collect()
    want = brute(vectors, range(0, 3000, 50), 5)
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        mine.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(mine) == set(want) and all(len(v) == 5 for v in mine.values())
    hit = sum(len({i for i, _ in mine[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 5 * len(want)
    exact = {(q, i): s for q, rows in brute(vectors, want, 3000).items() for i, s in rows}
    assert all(abs(s - exact[(q, i)]) < 1e-12 for q, rows in mine.items() for i, s in rows)
    assert all(rows == sorted(rows, key=lambda x: (-x[1], x[0])) for rows in mine.values())


def test_equal_vectors_ties_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    vectors = {i: rng.standard_normal(8).astype(np.float32) for i in range(200)}
    for i in range(40, 140):
        vectors[i] = vectors[40]  # a hot vector
    bad = [(500, None, "a"), (501, [0.0] * 8, "b"), (502, [1.0, float("nan")] + [0.0] * 6, "c"), (503, [None] + [1.0] * 7, "d"), (504, [float("inf")] + [1.0] * 7, "e"), (550, [1.0, 2.0], "f"), (None, [1.0] * 8, "g"), (600, [], "h")]
    df = frame(spark, [(i, v.tolist(), "x") for i, v in vectors.items()] + [(0, vectors[0].tolist(), "again")] + bad)
    got = ann.nearest(df, "vec_id % 50 = 0", k=5, stop=0.999, cell_rows=50).collect()
    want = brute(vectors, [0, 50, 100, 150], 5)
    mine = {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in want}
    assert {r.query_id for r in got} == set(want)
    assert [i for i, _ in mine[50]] == [40, 41, 42, 43, 44] and [i for i, _ in mine[100]] == [40, 41, 42, 43, 44]
    assert sum(len({i for i, _ in mine[q]} & {i for i, _ in want[q]}) for q in want) >= 18


def test_few_and_none(spark):
    df = frame(spark, [(0, [1.0, 0.0], "x"), (1, [1.0, 1.0], "y"), (2, [0.0, -1.0], "z")])
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(df, "vec_id % 50 = 0").orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert ann.nearest(df.limit(0), "vec_id % 50 = 0").collect() == []
    assert ann.nearest(df.where("vec_id = 0"), "vec_id % 50 = 0").collect() == []


def test_chi_square_quantile():
    assert abs(ann.chi_square_quantile(0.95, 2) - 5.991464547) < 1e-6 and abs(ann.chi_square_quantile(0.98, 8) - 18.168230856) < 1e-6


def test_tables(spark):
    """Recall on the whole table, against all distances."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float32) for r in df.collect()}
    got = ann.nearest(df, "vec_id % 50 = 0").collect()
    want = brute(vectors, [i for i in vectors if i % 50 == 0], 5)
    hit = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert hit >= 0.9 * 5 * len(want)
