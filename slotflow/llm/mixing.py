"""Mixing sources to target weights by hierarchical budgets, and seeded token prefixes.

The tree is domain - language - source. A leaf can give its tokens ``max_epochs`` times, a node
what its leaves can. From the root down, each node's budget goes to its children by weight; a
child that cannot use its part gives the shortage to its siblings by their weights, so that a
shortage leaves a node only when all its children are full, and then goes to the node's own
siblings. Shares are whole tokens, rounded down.

A leaf with budget b and t tokens takes every document b div t times, and in one more epoch a
prefix of the documents in seeded order (MD5 of seed, epoch and doc_id) while their running sum
of tokens is at most b mod t. The order is cut into ``BUCKETS`` ranges: their sums find the range
in which the prefix ends, and only documents of that range are summed one by one, so that no task
ever holds a leaf.

Tokens are words (runs without ASCII white space). Null text has none; null language or source
counts as ''; a null doc_id orders as ''. Rows that repeat a doc_id are ordered by their tokens.
Children without a weight get weight 1 (weight 0: nothing). A prefix holds documents without
tokens that come before its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.llm.common import SPACES, stage

BUCKETS = 4096  # three hexadecimal digits
# Production weights: a domain is a range of the source's hash (the tables name none).
DOMAINS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANGUAGES = {"en": 6, "de": 2, "fr": 1, "es": 1}
SOURCES: dict[str, int] = {}
SHARE = 80  # budget: percent of the corpus's tokens
EPOCHS = 2
SEED = 17
SMALL = 100_000
LEAF = ["domain", "lang", "source"]


def domain_of(source: Column) -> Column:
    digit = F.substring(F.md5(source.cast("binary")), 1, 1)
    return F.when(digit < "4", "d0").when(digit < "8", "d1").when(digit < "c", "d2").otherwise("d3")


def count_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+"))).cast("long")


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens) of every row."""
    source = F.coalesce("source", F.lit(""))
    return docs.select("doc_id", domain_of(source).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), source.alias("source"), count_words(F.col("text")).alias("n_tokens"))


def _weight(name: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, weight).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``alloc`` to children (parent..., child, weight, cap, budget): full children get their
    cap, the others the rest by weight. Ordered by cap / weight, the full ones come first."""
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("cap") / F.greatest("weight", F.lit(0.5)), child)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heavier = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = (F.col("weight") > 0) & (F.col("cap") * heavier <= F.col("weight") * (F.col("budget") - before))
    rows = children.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)))
    rows = rows.withColumn("full", full)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(F.lit(0))).over(group)
    rows = rows.withColumn("rest", rest).withColumn("open_weight", F.greatest(open_weight, F.lit(1)))
    alloc = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("weight * rest div open_weight"))
    return rows.withColumn("alloc", alloc).drop("full", "rest", "open_weight")


def budgets(leaf_rows: DataFrame, share: int, epochs: int, domains: dict, languages: dict, sources: dict) -> DataFrame:
    """(domain, lang, source, tokens, alloc) of every leaf."""
    leaf = leaf_rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    leaf = stage(leaf.withColumn("cap", F.col("tokens") * epochs).withColumn("weight", _weight("source", sources)), "leaves")
    usable = leaf.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)))
    langs = usable.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight("lang", languages))
    tops = langs.where("weight > 0").groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight("domain", domains))
    total = leaf.agg(F.expr(f"{share} * sum(tokens) div 100")).first()[0] or 0
    tops = share_out(tops.withColumn("budget", F.lit(total).cast("long")), [], "domain")
    langs = share_out(langs.join(tops.select("domain", F.col("alloc").alias("budget")), "domain"), ["domain"], "lang")
    out = share_out(leaf.join(langs.select("domain", "lang", F.col("alloc").alias("budget")), ["domain", "lang"]), ["domain", "lang"], "source")
    return stage(out.select(*LEAF, "tokens", "alloc"), "budgets")


def select(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Adds ``copies`` to the rows that some epoch takes. Tables with a row a leaf are broadcast up
    to ``SMALL`` leaves, so that no task gets a leaf's rows; beyond that they are joined by leaf."""
    side = F.broadcast if plan.count() <= SMALL else lambda df: df
    plan = plan.withColumn("whole", F.expr("alloc div greatest(tokens, 1)")).withColumn("rest", F.expr("alloc % greatest(tokens, 1)"))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    dealt = rows.join(side(plan.select(*LEAF, "whole", "rest")), LEAF)
    dealt = dealt.withColumn("at", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), doc).cast("binary")))
    dealt = stage(dealt.withColumn("bucket", F.substring("at", 1, 3)), "dealt")
    sums = dealt.groupBy(*LEAF, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    after = sums.withColumn("after", F.sum("n").over(Window.partitionBy(*LEAF).orderBy("bucket")))
    ends = after.where("after > rest").groupBy(*LEAF).agg(F.min(F.struct("bucket", (F.col("after") - F.col("n")).alias("before"))).alias("end"))
    dealt = dealt.join(side(ends), LEAF, "left")
    inside = dealt.where("rest > 0 AND (end IS NULL OR bucket < end.bucket)").withColumn("extra", F.lit(1))
    order = Window.partitionBy(*LEAF).orderBy("at", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = dealt.where("rest > 0 AND bucket = end.bucket").withColumn("sum", F.sum("n_tokens").over(order) + F.col("end.before"))
    edge = edge.withColumn("extra", F.when(F.col("sum") <= F.col("rest"), 1).otherwise(0)).drop("sum")
    beyond = dealt.where("rest = 0 OR bucket > end.bucket").withColumn("extra", F.lit(0))
    out = inside.unionByName(edge).unionByName(beyond).withColumn("copies", F.col("whole") + F.col("extra"))
    return out.where("copies > 0").select("doc_id", *LEAF, "n_tokens", "copies")


def mix(docs: DataFrame, share: int = SHARE, epochs: int = EPOCHS, seed: int = SEED, domains: dict = DOMAINS, languages: dict = LANGUAGES, sources: dict = SOURCES) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies): the rows taken, and how often."""
    rows = stage(leaves(docs), "tokens")
    return select(rows, budgets(rows, share, epochs, domains, languages, sources), seed)


def draw(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Rows that repeat a doc_id are taken
    as often as the one of them that is taken most."""
    taken = mix(docs, **settings).groupBy(F.col("doc_id").alias("mix_doc")).agg(F.max("copies").alias("mix_copies"))
    joined = docs.join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("mix_doc")))
    return joined.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(docs.columns)


def _case(name: str, weights: dict[str, int]) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END" if weights else "1"


def _share_sql(table: str, parent: str, child: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""SELECT * EXCLUDE (is_full, before, heavier), CASE WHEN is_full THEN cap ELSE weight * (budget - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({by}), 0))
        // greatest(coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER ({by}), 0), 1) END AS alloc
    FROM (SELECT *, weight > 0 AND cap * heavier <= weight * (budget - before) AS is_full
      FROM (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap / greatest(weight, 0.5), {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
          sum(weight) OVER ({by} ORDER BY cap / greatest(weight, 0.5), {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier
        FROM {table}) AS a) AS b"""


_DIGIT = "substr(md5(coalesce(source, '')), 1, 1)"
ORACLE_SQL = f"""
WITH tokens AS (
  SELECT doc_id, CASE WHEN {_DIGIT} < '4' THEN 'd0' WHEN {_DIGIT} < '8' THEN 'd1' WHEN {_DIGIT} < 'c' THEN 'd2' ELSE 'd3' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {EPOCHS} AS cap, {_case("source", SOURCES)} AS weight FROM tokens GROUP BY ALL),
lang_caps AS (SELECT domain, lang, sum(cap) AS cap, {_case("lang", LANGUAGES)} AS weight FROM leaf GROUP BY domain, lang),
top_caps AS (SELECT domain, sum(cap) AS cap, {_case("domain", DOMAINS)} AS weight, (SELECT {SHARE} * sum(tokens) // 100 FROM leaf) AS budget FROM lang_caps GROUP BY domain),
tops AS ({_share_sql("top_caps", "", "domain")}),
langs AS ({_share_sql("(SELECT l.*, t.alloc AS budget FROM lang_caps AS l JOIN (SELECT domain, alloc FROM tops) AS t USING (domain)) AS q", "domain", "lang")}),
plan AS (SELECT domain, lang, source, alloc // greatest(tokens, 1) AS whole, alloc % greatest(tokens, 1) AS rest
  FROM ({_share_sql("(SELECT f.*, l.alloc AS budget FROM leaf AS f JOIN (SELECT domain, lang, alloc FROM langs) AS l USING (domain, lang)) AS q", "domain, lang", "source")}) AS p),
ordered AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, n_tokens ROWS UNBOUNDED PRECEDING) AS running
  FROM (SELECT *, md5('{SEED}:' || whole::BIGINT || ':' || coalesce(doc_id::VARCHAR, '')) AS place FROM tokens JOIN plan USING (domain, lang, source)) AS d)
SELECT doc_id, domain, lang, source, n_tokens, copies
FROM (SELECT *, (whole + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM ordered) AS c WHERE copies > 0
"""
