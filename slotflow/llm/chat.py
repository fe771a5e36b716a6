"""Preference formatting of conversation pairs, in DataFrame functions only.

A pair is a chosen and a rejected conversation. Their common prefix is the turns below the
smallest turn number at which they differ (in role or text, or as only one has it). It becomes
the prompt, rendered once; what follows on either side becomes that side's completion. Results
have a row for each rendered turn with its place in its part, so that no conversation is ever
gathered in a cell; a part's text is its rows joined in order. The loss range covers what an
assistant says in a completion (with the end mark); all else is masked.

Turns are compared by digests in narrow rows, summed for each pair before the shuffle. Rows that
repeat a conversation's turn count once (of different ones the smallest role and text stays).
Null role or text is ''. Rows with a null conv_id or turn take no part, nor do pairs of which
one side has no turns. A pair of equal conversations has a prompt only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BEGIN, MIDDLE, END = "<|", "|>\n", "<|end|>\n"


def neighbours(turns: DataFrame) -> DataFrame:
    """(pair_id, conv_id, side): conversation 2k is chosen over 2k + 1."""
    ids = turns.where("conv_id IS NOT NULL").select("conv_id").distinct()
    side = F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected")
    return ids.select(F.expr("(conv_id - pmod(conv_id, 2)) div 2").alias("pair_id"), "conv_id", side.alias("side"))


def one_per_turn(turns: DataFrame) -> DataFrame:
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min(said).alias("said"))
    return rows.select("conv_id", "turn", "said.role", "said.text")


def first_difference(sided: DataFrame) -> DataFrame:
    """(pair_id, split): the smallest turn at which the sides differ; null if none."""
    digest = F.sha2(F.concat_ws("\x00", "role", "text"), 256)
    at = sided.select("pair_id", "turn", "side", digest.alias("d")).groupBy("pair_id", "turn").agg(
        F.min("d").alias("a"), F.max("d").alias("b"), F.min("side").alias("s"), F.max("side").alias("t")
    )
    differs = (F.col("a") != F.col("b")) | (F.col("s") == F.col("t"))
    whole = at.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("turn"))).alias("split"), F.min("s").alias("s"), F.max("t").alias("t")
    )
    return whole.where("s <> t").select("pair_id", "split")


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, content, begin, end, loss_begin, loss_end): part is prompt,
    chosen or rejected; begin and end place the rendered turn in its part."""
    sided = one_per_turn(turns).join(pairs.select("pair_id", "conv_id", "side"), "conv_id").drop("conv_id")
    rows = sided.join(first_difference(sided), "pair_id")
    prompt = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    rows = rows.where(~prompt | (F.col("side") == "chosen")).withColumn("part", F.when(prompt, "prompt").otherwise(F.col("side")))
    rows = rows.withColumn("content", F.concat(F.lit(BEGIN), "role", F.lit(MIDDLE), "text", F.lit(END)))
    order = Window.partitionBy("pair_id", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.length("content").cast("long")).over(order)).withColumn("begin", F.col("end") - F.length("content"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    said = F.col("begin") + len(BEGIN) + F.length("role") + len(MIDDLE)
    return rows.select("pair_id", "part", "turn", "role", "content", "begin", "end", F.when(trained, said).alias("loss_begin"), F.when(trained, F.col("end")).alias("loss_end"))


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, said.role AS role, said.text AS text
  FROM (SELECT conv_id, turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS said
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn) AS t),
sided AS (
  SELECT (conv_id - ((conv_id % 2) + 2) % 2) // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, turn, role, text
  FROM turns),
paired AS (SELECT pair_id FROM sided GROUP BY pair_id HAVING count(DISTINCT side) = 2),
splits AS (
  SELECT pair_id, min(CASE WHEN differs THEN turn END) AS split
  FROM (SELECT pair_id, turn, count(DISTINCT side) < 2 OR min(role) <> max(role) OR min(text) <> max(text) AS differs FROM sided GROUP BY pair_id, turn) AS d
  JOIN paired USING (pair_id) GROUP BY pair_id),
parts AS (
  SELECT pair_id, CASE WHEN split IS NULL OR turn < split THEN 'prompt' ELSE side END AS part, side, turn, role,
    '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS content
  FROM sided JOIN splits USING (pair_id)),
placed AS (
  SELECT *, sum(length(content)) OVER (PARTITION BY pair_id, part ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS "end"
  FROM parts WHERE part <> 'prompt' OR side = 'chosen')
SELECT pair_id, part, turn, role, content, "end" - length(content) AS begin, "end",
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN "end" - length(content) + 5 + length(role) END AS loss_begin,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN "end" END AS loss_end
FROM placed
"""
