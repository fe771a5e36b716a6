"""Mix against DuckDB and a plain water level."""

import random

import pytest
from check_oracle import canon, duck
from pyspark.sql import functions as F

from slotflow.llm import mixing
from slotflow.llm.registry import ORACLE, QUERIES


def corpus(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", "fr", "xx", None]), rng.choice(["big", "big", f"s{i % 9}", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 200])), lang, source))
    return rows + [(n, None, None, None), (None, "no id", "en", "big")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_sql(spark, tmp_path, seed):
    df = spark.createDataFrame(corpus(seed), "doc_id long, text string, lang string, source string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    next((tmp_path / "d").glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    got = QUERIES["op5_source_mix"](spark, str(tmp_path))
    cols, lines, _ = canon(got.columns, [tuple(r) for r in got.collect()])
    assert (cols, lines) == canon(*duck(str(tmp_path), ORACLE["op5_source_mix"]))[:2]


def level(children, budget):
    """Shares by repeated rounds: whoever is full leaves, the rest shares what is left."""
    alloc, open_ = {}, dict(children)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {c: cap for c, (w, cap) in open_.items() if cap * weight <= w * budget}
        if not full:
            return alloc | {c: w * budget // weight for c, (w, _) in open_.items()}
        alloc |= full
        budget -= sum(full.values())
        open_ = {c: x for c, x in open_.items() if c not in full}
    return alloc


def test_share_out(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for g in range(40):
        children = {f"c{k}": (rng.randint(1, 9), rng.choice([0, rng.randint(0, 1000)])) for k in range(rng.randint(1, 8))}
        budget = rng.randint(0, 2500)
        rows += [(g, c, w, cap, budget) for c, (w, cap) in children.items()]
        want |= {(g, c): a for c, a in level(children, budget).items()}
    df = spark.createDataFrame(rows, "g int, c string, weight long, cap long, budget long")
    assert {(r.g, r.c): r.alloc for r in mixing.share_out(df, ["g"], "c").collect()} == want


def test_shortage_stays_with_siblings_and_weight_zero(spark):
    rows = [(1, "a " * 10, "en", "x"), (2, "a " * 500, "en", "y"), (3, "a " * 500, "de", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", F.lit(1))
    plan = {r.source: r.alloc for r in mixing.budgets(mixing.leaves(df).withColumn("domain", F.lit("d")), 50, 1, {}, {"en": 1, "de": 1}, {"z": 1}).collect()}
    assert plan == {"x": 10, "y": 242, "z": 252}
    none = {r.source: r.alloc for r in mixing.budgets(mixing.leaves(df).withColumn("domain", F.lit("d")), 90, 1, {}, {}, {"y": 0}).collect()}
    assert none == {"x": 10, "y": 0, "z": 500}


def test_draw_repeats_rows(spark):
    df = spark.createDataFrame([(i, "a b c d", "en", "s", "k") for i in range(40)] + [(40, None, None, None, None)], "doc_id long, text string, lang string, source string, copies string")
    got = mixing.draw(df, share=150, epochs=2, domains={}, languages={}, sources={})
    assert got.columns == df.columns
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert sum(counts.values()) == 60 and set(counts) == set(range(40)) and set(counts.values()) == {1, 2}
    assert mixing.draw(df.limit(0)).collect() == []
