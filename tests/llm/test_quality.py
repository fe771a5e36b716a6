"""Quality rules against plain Python measures; the verdict against DuckDB."""

import random
import re
from collections import Counter

from check_oracle import canon, duck
from slotflow.llm import quality
from slotflow.llm.registry import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def measured(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_measures(spark):
    rng = random.Random(4)
    vocab = ["a", "b", "é", "🙂", "x#", "*", "<b>", "c"]
    texts = [None, "", " \n\n ", "a", "a b", "a b c", "a a a a", "a b a b a b", "a\x1cb c", "\x0b a \x0c b", "x\ny\nx\n \n \nx"]
    texts += ["".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    texts += [" ".join(f"w{rng.randrange(2000)}" for _ in range(40_000))]
    assert measured(spark, texts) == [plain(t) for t in texts]


def test_hash_clashes_take_the_exact_way(spark, monkeypatch):
    monkeypatch.setattr(quality, "_INDEX_BITS", 62)  # two bits of hash: nearly all windows clash
    texts = ["a b c d e f g a b c x y z", "a b c a b c", "one two three four five six"]
    assert [m[4] for m in measured(spark, texts)] == [plain(t)[4] for t in texts]


def test_verdict_matches_sql(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["big", "big", "mid", f"s{i % 40}", None])
        words = [f"{rng.choice('abcdef')}{rng.randrange(900)}" for _ in range(rng.randint(45, 120))]
        if i % 17 == 0:
            words = [w + "###" for w in words]
        if i % 23 == 0:
            words = [w * 12 for w in words]
        rows.append((i, " ".join(words), lang, source, 0))
    rows += [(1500, None, None, None, None), (1501, "", "en", "big", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "d"))
    part = next((tmp_path / "d").glob("part-*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    got = QUERIES["op1_quality_rules"](spark, str(tmp_path))
    cols, lines, _ = canon(got.columns, [tuple(r) for r in got.collect()])
    want_cols, want, _ = canon(*duck(str(tmp_path), ORACLE["op1_quality_rules"]))
    assert (cols, lines) == (want_cols, want)
    rejected = {r.doc_id for r in got.where("NOT kept AND NOT base_failed").collect()}
    assert {i for i in range(0, 1500, 17)} & rejected and not rejected - {i for i in range(1500) if i % 17 == 0 or i % 23 == 0}


def test_accept(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, "en", "s", 5), (2, "short", "en", "s", 5), (None, "short", None, None, None)], "doc_id long, text string, lang string, source string, kept long")
    got = quality.accept(df)
    assert got.columns == df.columns and sorted((r.doc_id or 0) for r in got.collect()) == [0, 1]
    assert quality.accept(df.limit(0)).collect() == [] and quality.judge(df.limit(0)).collect() == []
