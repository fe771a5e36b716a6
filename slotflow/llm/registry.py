"""The corpus queries: one for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from slotflow.llm import ann, chat, infill, licenses, mixing, near, pieces, pii, quality, repeats, resampling, shards, tokens
from slotflow.llm.common import prepare, table
from slotflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


@register("op1_quality_rules", quality.ORACLE_SQL)
def op1(spark, sf_dir):
    """Operator 1: measures of every document, the base rule, and the verdict of adaptive fences."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("lang", "source", "n_lines")


@register("op2_nearest_neighbours")
def op2(spark, sf_dir):
    """Operator 2: the 5 nearest vectors by cosine for each vec_id divisible by 50."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


@register("op3_personal_data")
def op3(spark, sf_dir):
    """Operator 3: spans of personal data by patterns, and of terms that reveal it."""
    return pii.report(table(spark, sf_dir, "documents"))


@register("op4_token_counts")
def op4(spark, sf_dir):
    """Operator 4: byte-level BPE token counts through a digest cache. The query starts with an
    empty cache, so that it encodes every distinct text."""
    cache = scratch_path(spark, "token-cache")
    tokens.create_cache(spark, cache)
    return tokens.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)


@register("op5_source_mix", mixing.ORACLE_SQL)
def op5(spark, sf_dir):
    """Operator 5: documents drawn for a budget of 80 % of all tokens by domain, language and
    source weights."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@register("op6_preference_format", chat.ORACLE_SQL)
def op6(spark, sf_dir):
    """Operator 6: conversations 2k and 2k + 1 as chosen and rejected, with their common prompt."""
    turns = table(spark, sf_dir, "conversations")
    return chat.format_pairs(turns, chat.neighbours(turns))


@register("op7_license_scan")
def op7(spark, sf_dir):
    """Operator 7: license phrases and signature rules in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op8_substring_dedup")
def op8(spark, sf_dir):
    """Operator 8: words left after 20-word windows that also start earlier are removed."""
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


@register("op9_sentencepiece")
def op9(spark, sf_dir):
    """Operator 9: piece ids of every document, and whether they decode to its text."""
    return pieces.report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op10_ngram_jaccard_join")
def op10(spark, sf_dir):
    """Operator 10: components of documents whose 3-word shingle sets have a Jaccard similarity of
    90 percent or more."""
    return near.near_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@register("op11_importance_resampling", resampling.ORACLE_SQL)
def op11(spark, sf_dir):
    """Operator 11: a tenth of the documents, drawn to resemble the benchmark texts."""
    return resampling.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_token_shards")
def op12(spark, sf_dir):
    """Operator 12: token ids written as indexed binary shards, and read back through the index."""
    folder = scratch_path(spark, "token-shards")
    return shards.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)


@register("op13_fill_in_middle", infill.ORACLE_SQL)
def op13(spark, sf_dir):
    """Operator 13: every document as prefix, suffix and middle, and restored from that."""
    return infill.report(table(spark, sf_dir, "documents"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """The corpus pipeline: quality, near copies, personal data, mixing, piece encoding."""
    return corpus_pipeline.run(spark, sf_dir)
