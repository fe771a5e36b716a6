"""Quality rules with adaptive thresholds, in DataFrame functions only.

Measures of every document (in whole numbers, so that any engine agrees): mean word length,
symbols, repeated lines and repeated three-word windows, each as a share of the text. Their
distribution is sketched for each language and source: a count for each bucket of about 3 %
relative width. Such sketches merge by adding counts, in any order and with the same result.
Fences are set at a distance of several interquartile ranges from the quartiles; a source with
fewer than ``MIN_DOCS`` documents takes the fences of its language's merged sketch, a language
with fewer those of the whole corpus. The fences (one row for each language and source) are
joined to the measures, and a document outside any of them is rejected.

Only documents that pass the base rule shape the sketches. Null text is a text without words.
Null language or source counts as ''. Repeated rows each get their result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.llm.common import SPACES, stage

MIN_WORDS = 50
MIN_DOCS = 200
SYMBOLS = "#*$%&|<>"
#: distance of a fence from its quartile, in interquartile ranges
FENCE = 3
#: measure: (numerator, denominator, scale, least interquartile range, whether it has a lower fence)
MEASURES = {
    "m_length": ("word_chars", "n_words", 100, 100, True),
    "m_symbols": ("n_symbols", "n_words", 1000, 40, False),
    "m_lines": ("n_dup_lines", "n_lines", 1000, 200, False),
    "m_repeats": ("n_repeat_words", "n_words", 1000, 150, False),
}
_INDEX_BITS = 24


def _long(x) -> Column:
    return F.lit(x).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed) of every row."""
    text = F.coalesce("text", F.lit(""))
    spaces, symbols = F.lit(SPACES), F.lit(SYMBOLS)
    rows = docs.select("doc_id", "lang", "source", text.alias("t"))
    rows = rows.select(
        "doc_id", "lang", "source", "t",
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.split(F.btrim("t", spaces), "[ \\t-\\r]+").alias("w"),
        F.filter(F.split("t", "\n"), lambda line: F.btrim(line, spaces) != "").alias("lines"),
    )
    rows = rows.withColumn("n", F.when(F.col("word_chars") == 0, 0).otherwise(F.size("w")))
    # a key for each three-word window: 40 bits of its hash, then its index
    key = lambda x, i: F.shiftleft(F.shiftright(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)), _INDEX_BITS), _INDEX_BITS).bitwiseOR(i.cast("long"))
    rows = rows.withColumn("keys", F.sort_array(F.transform(F.slice("w", 1, F.greatest(F.col("n") - 2, F.lit(0))), key)))
    part = lambda x: F.shiftright(x, _INDEX_BITS)
    index = lambda x: x.bitwiseAND(_long((1 << _INDEX_BITS) - 1)).cast("int")
    twice = lambda x, k: (part(x) == part(F.get("keys", k + 1))) | (part(x) == part(F.get("keys", k - 1)))
    rows = rows.withColumn("again", F.filter("keys", lambda x, k: F.coalesce(twice(x, k), F.lit(False))))
    words_at = lambda x: F.slice("w", index(x) + 1, 3)
    clash = F.exists(F.transform("again", lambda x, k: (part(x) == part(F.get("again", k + 1))) & (words_at(x) != words_at(F.get("again", k + 1)))), lambda c: F.coalesce(c, F.lit(False)))
    rows = rows.withColumn("places", F.when(clash | (F.col("n") > (1 << _INDEX_BITS)), _exact_places()).otherwise(F.sort_array(F.transform("again", index))))
    covers = F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3))))
    rows = rows.select(
        "doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covers, _long(0), lambda a, x: a + x).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _exact_places() -> Column:
    """Starts of repeated windows by their words: where two windows share 40 bits of hash, or a
    text has more words than the index can hold."""
    grams = F.array_sort(F.transform(F.slice("w", 1, F.greatest(F.col("n") - 2, F.lit(0))), lambda x, i: F.struct(F.slice("w", i + 1, 3).alias("g"), i.alias("i"))))
    paired = F.transform(F.sequence(F.lit(0), F.size(grams) - 1), lambda k: F.struct(F.get(grams, k).alias("own"), F.get(grams, k - 1).alias("left"), F.get(grams, k + 1).alias("right")))
    again = F.filter(paired, lambda p: F.coalesce(p.own.g == p.left.g, F.lit(False)) | F.coalesce(p.own.g == p.right.g, F.lit(False)))
    return F.sort_array(F.transform(again, lambda p: p.own.i))


def _bucket(v: Column) -> Column:
    """The lower end of v's bucket: six leading binary digits."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    size = F.element_at(F.array(*[_long(1 << k) for k in range(58)]), shift + 1)
    return v - F.pmod(v, size)


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): mergeable by adding n."""
    values = [
        F.struct(F.lit(name).alias("measure"), F.expr(f"{scale} * {top} div greatest({below}, 1)").alias("v"))
        for name, (top, below, scale, _, _) in MEASURES.items()
    ]
    passed = measures.where(~F.col("base_failed")).select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.explode(F.array(*values)).alias("x"))
    return passed.groupBy("lang", "source", F.col("x.measure").alias("measure"), _bucket(F.col("x.v")).alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each value of ``keys``: n_docs and, for each measure, its low and high fence."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("below", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    quartiles = ranked.groupBy(*keys, "measure").agg(
        F.min(F.when(4 * F.col("below") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("below") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
        F.max("total").alias("total"),
    )
    out = [F.max("total").alias("n_docs")]
    for name, (_, _, _, least, low) in MEASURES.items():
        own = lambda c: F.max(F.when(F.col("measure") == name, c))  # noqa: B023, E731
        reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), _long(least))
        out.append(own(F.col("q3") + reach).alias(f"{name}_high"))
        if low:
            out.append(own(F.col("q1") - reach).alias(f"{name}_low"))
    return quartiles.groupBy(*keys).agg(*out)


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, fences): of the source, or of the smallest merged sketch that is large enough."""
    names = [f"{m}_high" for m in MEASURES] + [f"{m}_low" for m, x in MEASURES.items() if x[4]]
    named = lambda frame, p: frame.select(*[c for c in frame.columns if c in ("lang", "source")], *[F.col(c).alias(f"{p}_{c}") for c in ["n_docs", *names]])
    whole = fences(sketch, []).first()  # one row: the corpus's fences
    by_lang = named(fences(sketch, ["lang"]), "b")
    joined = named(fences(sketch, ["lang", "source"]), "a").join(by_lang, "lang")
    pick = lambda c: F.when(F.col("a_n_docs") >= MIN_DOCS, F.col(f"a_{c}")).when(F.col("b_n_docs") >= MIN_DOCS, F.col(f"b_{c}")).otherwise(_long(whole[c])).alias(c)
    return joined.select("lang", "source", *[pick(c) for c in names])


def judge(docs: DataFrame) -> DataFrame:
    """The measures of every row with ``base_failed`` and the verdict ``kept``."""
    measures = stage(measure(docs), "measures")
    limits = stage(thresholds(stage(sketches(measures), "sketch")), "fences")
    limits = limits.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[c for c in limits.columns if c not in ("lang", "source")])
    on = (F.coalesce("lang", F.lit("")) == F.col("f_lang")) & (F.coalesce("source", F.lit("")) == F.col("f_source"))
    joined = measures.join(limits, on, "left")
    inside = F.lit(True)
    for name, (top, below, scale, _, low) in MEASURES.items():
        value = F.expr(f"{scale} * {top} div greatest({below}, 1)")
        inside = inside & (value <= F.col(f"{name}_high"))
        if low:
            inside = inside & (value >= F.col(f"{name}_low"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.withColumn("kept", kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "source", "n_lines")


def accept(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected; a doc_id goes if any of its rows is rejected, rows with a
    null doc_id stay."""
    rejected = judge(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(rejected.hint("merge"), "doc_id", "left_anti").select(docs.columns)


_VALUES = "\nUNION ALL\n".join(
    f"SELECT lang, source, '{name}' AS measure, {scale} * {top} // greatest({below}, 1) AS v FROM measures WHERE NOT base_failed"
    for name, (top, below, scale, _, _) in MEASURES.items()
)
_LEAST = " ".join(f"WHEN '{name}' THEN {x[3]}" for name, x in MEASURES.items())
_LOW = ", ".join(f"'{name}'" for name, x in MEASURES.items() if x[4])
_OWN = "\nUNION ALL\n".join(
    f"SELECT doc_id, lang, source, '{name}' AS measure, {scale} * {top} // greatest({below}, 1) AS v FROM measures"
    for name, (top, below, scale, _, _) in MEASURES.items()
)


def _fence_sql(keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}measure, max(total) AS n_docs,
        min(CASE WHEN 4 * below >= 3 * total THEN bucket END) AS q3, min(CASE WHEN 4 * below >= total THEN bucket END) AS q1
    FROM (SELECT {lead}measure, bucket, sum(n) OVER (PARTITION BY {lead}measure ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY {lead}measure) AS total
          FROM (SELECT {lead}measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL) AS merged) AS ranked
    GROUP BY {lead}measure"""


ORACLE_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[^ \\t-\\r]+') AS w FROM texts) AS x) AS y),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM words) AS z WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts) AS l WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY doc_id),
measures AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM (SELECT doc_id, lang, source, len(regexp_extract_all(t, '[^ \\t-\\r]+')) AS n_words,
      length(regexp_replace(t, '[ \\t-\\r]+', '', 'g')) AS word_chars,
      length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
      coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)) AS m),
sketch AS (
  SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS bucket, count(*) AS n
  FROM ({_VALUES}) AS vals GROUP BY ALL),
by_source AS ({_fence_sql("lang, source")}),
by_lang AS ({_fence_sql("lang")}),
whole AS ({_fence_sql("")}),
picked AS (
  SELECT s.lang, s.source, measure,
    CASE WHEN s.n_docs >= {MIN_DOCS} THEN s.q1 WHEN l.n_docs >= {MIN_DOCS} THEN l.q1 ELSE g.q1 END AS q1,
    CASE WHEN s.n_docs >= {MIN_DOCS} THEN s.q3 WHEN l.n_docs >= {MIN_DOCS} THEN l.q3 ELSE g.q3 END AS q3
  FROM by_source AS s JOIN by_lang AS l USING (lang, measure) JOIN whole AS g USING (measure)),
outside AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, measure, v, q1, q3, {FENCE} * greatest(q3 - q1, CASE measure {_LEAST} END) AS reach
    FROM ({_OWN}) AS own JOIN picked USING (lang, source, measure)) AS f
  WHERE v > q3 + reach OR (measure IN ({_LOW}) AND v < q1 - reach))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM measures
"""
