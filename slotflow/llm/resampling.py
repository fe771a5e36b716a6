"""Importance resampling towards a target: hashed n-gram weights, and an exact draw of the best.

Weights. Every run of 1 to ``max_words`` words is a feature, its bucket the crc32 of its bytes
modulo ``buckets``. One pass over the documents and one over the target count the buckets (each
task sums its own array, the tables that meet have ``buckets`` rows at most). The gains, one number
a bucket, are the only thing that tasks are sent; a second pass scores each document by an array
look-up. The score adds a Gumbel draw of the document's id to the weight, so that the highest
scores are a draw without replacement.

Ranks, by parallel sorting by regular sampling. Each task sorts its rows as runs of ``RUN`` rows
and keeps them packed. Every run gives samples at regular distances (``SAMPLES`` for each segment
in all, so their number does not grow with the input), and regular places of the sorted samples are
the splitters. Runs are cut at the splitters, segments exchanged and merged, each in its own task;
the counts of the segments before it, and a row's place in its own, give the exact rank. Rows travel
packed with all their columns, so nothing is joined back, and ties are ordered by every column:
equal doc_ids cannot make two runs of the job differ.

Null texts have no words. Rows with a null doc_id have no draw: their score and rank are null, and
they are not among the N documents. A repeated doc_id is drawn for row by row. Only doc_id and text
are read. A bucket that neither side holds gains by its prior alone; an empty target or table gives
the same formula with zero counts.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import shuffle_width, slices, stage

RUN = 1 << 16
SAMPLES = 32
STRETCH = 1 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score"]
_PACKED = np.dtype([(c, "<i8") for c in COLUMNS])
_ORDER = ("score", "doc_id", "n_features", "weight", "n_words")  # score descending, the rest ascending


# ------------------------------------------------------------------ features
def word_lists(text: bytes, max_words: int) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in stretches, so that a long text needs little memory: (words, how many
    of them only precede the stretch's own)."""
    text, at, before = text.lower(), 0, []
    while at < len(text) or at == 0:
        end = len(text)
        if end - at > STRETCH and (border := _BREAK.search(text, at + STRETCH)):
            end = border.start()
        words = _WORD.findall(text, at, end)
        yield before + words, len(before)
        before = (before + words)[-(max_words - 1) :] if max_words > 1 else []
        at = max(end, 1)


def features(words: list[bytes], skip: int, max_words: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of 1 to ``max_words`` words that end behind the first ``skip`` words."""
    hashes = []
    for k in range(1, max_words + 1):
        runs = words[skip:] if k == 1 else [b" ".join(words[i : i + k]) for i in range(max(skip - k + 1, 0), len(words) - k + 1)]
        hashes.append(np.fromiter(map(crc32, runs), np.int64, len(runs)) % buckets)
    return np.concatenate(hashes)


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return pc.cast(part.column("text").fill_null(""), pa.binary()).to_pylist()


def _count(batches: Iterator[pa.RecordBatch], max_words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for part in slices(batches):
        for text in _texts(part):
            for words, skip in word_lists(text, max_words):
                total += np.bincount(features(words, skip, max_words, buckets), minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, max_words: int, buckets: int) -> np.ndarray:
    """How many features of all rows' ``text`` fall into each bucket."""
    own = texts.select("text").mapInArrow(lambda it: _count(it, max_words, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in own.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, floor(1000 * ln) of the ratio of its smoothed shares in target and source."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))
    return np.array([math.floor(1000 * math.log(ratio(int(s), int(t)))) for s, t in zip(source, target)], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    """The draw of a document: floor(-1000 * ln(-ln(u))), u from a hash of its id."""
    h = int.from_bytes(hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches: Iterator[pa.RecordBatch], gain: np.ndarray, max_words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out = {c: [] for c in COLUMNS}
        for doc_id, text in zip(part.column("doc_id").to_pylist(), _texts(part)):
            n_words = n = total = 0
            for words, skip in word_lists(text, max_words):
                found = features(words, skip, max_words, len(gain))
                n_words, n, total = n_words + len(words) - skip, n + len(found), total + int(gain[found].sum())
            weight = total // n if n else 0
            for c, v in zip(COLUMNS, (doc_id, n_words, n, weight, None if doc_id is None else weight + gumbel(doc_id, seed))):
                out[c].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64()) for c in COLUMNS], COLUMNS)


# ------------------------------------------------------------------ sorting by regular sampling
def sort_rows(rows: np.ndarray) -> np.ndarray:
    keys = [rows[c] if c != "score" else -rows[c] for c in reversed(_ORDER)]
    return rows[np.lexsort(keys)]


def _key(row) -> tuple:
    return (-int(row["score"]), *(int(row[c]) for c in _ORDER[1:]))


def _runs(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs of a task's rows, packed, each with its regular samples."""
    held: list[np.ndarray] = []

    def done(rows: list[np.ndarray]) -> pa.RecordBatch:
        run = sort_rows(np.concatenate(rows))
        samples = run[int(run["doc_id"][0]) * 40503 % step :: step]  # a run starts anywhere in a step
        return pa.RecordBatch.from_arrays([pa.array([run.tobytes()]), pa.array([samples.tobytes()])], ["run", "samples"])

    for batch in batches:
        rows = np.empty(batch.num_rows, _PACKED)
        for c in COLUMNS:
            rows[c] = batch.column(c).to_numpy()
        held.append(rows)
        while sum(map(len, held)) >= RUN:
            every = np.concatenate(held)
            held = [every[RUN:]]
            yield done([every[:RUN]])
    if sum(map(len, held)):
        yield done(held)


def splitters(samples: np.ndarray, segments: int) -> np.ndarray:
    """Rows at regular places of the sorted samples: where segments begin."""
    samples = sort_rows(samples)
    at = np.unique(np.arange(1, segments) * len(samples) // segments) if len(samples) else []
    return samples[at]


def _cut(batches: Iterator[pa.RecordBatch], borders: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The segments of each run."""
    for batch in batches:
        for packed in batch.column("run").to_pylist():
            run = np.frombuffer(packed, _PACKED)
            places = [bisect_left(range(len(run)), _key(b), key=lambda i: _key(run[i])) for b in borders]
            edges = np.array([0, *places, len(run)])
            some = np.flatnonzero(np.diff(edges))
            blocks = [run[edges[k] : edges[k + 1]].tobytes() for k in some]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.diff(edges)[some]), pa.array(blocks, pa.binary())], ["segment", "n", "block"])


def _merge(batches: Iterator[pa.RecordBatch], first: dict[int, int], drawn: int) -> Iterator[pa.RecordBatch]:
    """Rows with their ranks, from the blocks of a partition, which is sorted by segment. A segment
    that starts behind the last rank drawn is passed on unmerged."""
    segment, blocks = None, []

    def done(rows: np.ndarray, rank: np.ndarray) -> pa.RecordBatch:
        ranks = pa.array(rank, pa.int64(), mask=rank > drawn)
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(rows[c])) for c in COLUMNS), ranks], [*COLUMNS, "rank"])

    def merged() -> Iterator[pa.RecordBatch]:
        if blocks:
            rows = sort_rows(np.concatenate(blocks))
            yield done(rows, first[segment] + 1 + np.arange(len(rows)))

    for batch in batches:
        for k, block in zip(batch.column("segment").to_pylist(), batch.column("block").to_pylist()):
            rows = np.frombuffer(block, _PACKED)
            if first[k] >= drawn:
                yield done(rows, np.full(len(rows), drawn + 1))
                continue
            if k != segment:
                yield from merged()
                segment, blocks = k, []
            blocks.append(rows)
    yield from merged()


def top_ranks(rows: DataFrame, drawn: int, total: int) -> DataFrame:
    """``rows`` (COLUMNS, no nulls; ``total`` of them) with ``rank``: 1 to ``drawn`` by falling
    score, null behind."""
    width = shuffle_width(rows.sparkSession)
    step = max(1, total // (width * SAMPLES))
    runs = stage(rows.select(COLUMNS).mapInArrow(lambda it: _runs(it, step), "run binary, samples binary"), "runs")
    taken = [np.frombuffer(r["samples"], _PACKED) for r in runs.select("samples").where("length(samples) > 0").collect()]  # about ``width * SAMPLES`` rows
    borders = splitters(np.concatenate([np.empty(0, _PACKED), *taken]), width)
    cut = stage(runs.select("run").mapInArrow(lambda it: _cut(it, borders), "segment long, n long, block binary"), "segments")
    sizes = {r["segment"]: r["n"] for r in cut.groupBy("segment").agg(F.sum("n").alias("n")).collect()}  # ``width`` rows at most
    first, before = {}, 0
    for k in sorted(sizes):
        first[k], before = before, before + sizes[k]
    dealt = cut.select("segment", "block").repartition(width, "segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(lambda it: _merge(it, first, drawn), ", ".join(f"{c} long" for c in [*COLUMNS, "rank"]))


# ------------------------------------------------------------------ the operator
def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, max_words: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``: rank 1 to
    ``percent`` of 100 of the rows with ``min_words`` words, drawn to resemble ``target`` (text)."""
    gain = gains(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _score(it, gain, max_words, seed), ", ".join(f"{c} long" for c in COLUMNS))
    scored = stage(scored, "scored")
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    total = scored.where(fit).count()
    ranked = top_ranks(scored.where(fit), percent * total // 100, total)
    return ranked.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).drop("n_words")


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
doc_words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
item_words AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT w, list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))) AS b
  FROM (SELECT DISTINCT w FROM doc_words UNION SELECT DISTINCT w FROM item_words)),
buckets AS (SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) % 10000 AS bucket FROM words, tab),
source AS (SELECT bucket, count(*) AS s FROM doc_words JOIN buckets USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM item_words JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM doc_words) AS s_all, (SELECT count(*) FROM item_words) AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM source LEFT JOIN target USING (bucket), totals),
sums AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM doc_words JOIN buckets USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN sums USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
