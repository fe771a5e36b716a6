"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, put in another order.

All texts of an Arrow slice are one array of bytes. A scan of its line ends gives the cuts. Each
segment (prefix, middle, suffix) moves by one distance, its displacement; the displacements'
differences stand at the segments' first bytes, and their cumulative sum gives every byte its
shift, with which one scatter builds all outputs. Restoring finds the marks, writes the differences
for the bytes of the original and gathers. Both run in blocks, so that a long text needs its own
size and little more.

A text is left as it is (form "plain") if it is null, empty or holds a mark, or by ``rate``; a null
doc_id has no hash and is plain. Repeated rows get equal results. Only doc_id and text are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import slices, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
BLOCK = 1 << 21
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """h1 to h4 of a document: the first four 8-digit groups of a hash of its id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def scan_cuts(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each row, and the byte positions behind ``first % (lines + 1)`` and
    ``second % (lines + 1)`` of them, the smaller one first."""
    ends = np.flatnonzero(data == 10) + 1
    at = np.searchsorted(ends, offsets, "right")
    closed = np.diff(at)
    open_line = np.zeros(len(closed), np.int64)
    some = np.diff(offsets) > 0
    open_line[some] = data[offsets[1:][some] - 1] != 10
    n = closed + open_line

    def place(units: np.ndarray) -> np.ndarray:
        pos = np.where(units > closed, offsets[1:], offsets[:-1])
        inside = (units > 0) & (units <= closed)
        pos[inside] = ends[at[:-1][inside] + units[inside] - 1]
        return pos

    a, b = first % (n + 1), second % (n + 1)
    return n, place(np.minimum(a, b)), place(np.maximum(a, b))


def _shifts(starts: np.ndarray, moves: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, target of each byte) for blocks of ``size`` bytes, where segments that start at
    ``starts`` (ascending) move by ``moves``: a cumulative sum over the array of differences."""
    step, carry = np.diff(moves, prepend=0), 0
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        own = slice(*np.searchsorted(starts, (low, high)))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[own] - low, step[own])
        shift = np.cumsum(difference) + carry
        carry = int(shift[-1])
        yield low, high, shift + np.arange(low, high)


def scatter(data: np.ndarray, offsets: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of all rows as bytes, and their offsets."""
    prefix, middle, suffix = cut1 - offsets[:-1], cut2 - cut1, offsets[1:] - cut2
    moved = form != PLAIN
    out_at = np.concatenate(([0], np.cumsum(np.diff(offsets) + 9 * moved)))
    base = out_at[:-1]
    to_prefix = base + np.where(form == SPM, suffix + 6, 3 * moved)
    to_suffix = np.where(form == SPM, base + 3, base + prefix + np.where(moved, 6, middle))
    to_middle = base + prefix + np.where(moved, suffix + 9, 0)
    starts = np.stack((offsets[:-1], cut1, cut2), 1).ravel()
    targets = np.stack((to_prefix, to_middle, to_suffix), 1).ravel()
    out = np.zeros(int(out_at[-1]), np.uint8)
    for low, high, target in _shifts(starts, targets - starts, len(data)):
        out[target] = data[low:high]
    for mark, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        out[at[moved][:, None] - 3 + np.arange(3)] = np.frombuffer(mark, np.uint8)
    return out, out_at


def find_marks(out: np.ndarray, offsets: np.ndarray, mark: bytes) -> np.ndarray:
    """The position behind the first ``mark`` of each row; the row's start where there is none."""
    hit = np.flatnonzero((out[:-2] == mark[0]) & (out[1:-1] == mark[1]) & (out[2:] == mark[2])) if len(out) > 2 else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, hit, "right") - 1
    inside = hit + 3 <= offsets[row + 1]
    row, hit = row[inside], hit[inside]
    behind = offsets[:-1].copy()
    behind[row[::-1]] = hit[::-1] + 3  # the first of a row is written last
    return behind


def gather(out: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The original texts of all rows as bytes, and their offsets, from outputs and forms alone."""
    p, s, m = (find_marks(out, offsets, mark) for mark in MARKS)
    moved, end = form != PLAIN, offsets[1:]
    prefix = np.where(moved, np.where(form == SPM, m, s) - 3 - p, np.diff(offsets))
    middle = np.where(moved, end - m, 0)
    text_at = np.concatenate(([0], np.cumsum(np.diff(offsets) - 9 * moved)))
    starts = np.stack((text_at[:-1], text_at[:-1] + prefix, text_at[:-1] + prefix + middle), 1)
    sources = np.stack((np.where(moved, p, offsets[:-1]), m, np.where(moved, s, end)), 1)
    sources[~moved, 1] = end[~moved]
    starts, sources = starts.ravel(), sources.ravel()
    text = np.zeros(int(text_at[-1]), np.uint8)
    for low, high, source in _shifts(starts, sources - starts, len(text)):
        text[low:high] = out[source]
    return text, text_at


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2]).cast(pa.string())


def _chars(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[int]:
    return [int(np.count_nonzero((data[a:b] & 0xC0) != 0x80)) for a, b in zip(starts, ends)]


def _transform(batches: Iterator[pa.RecordBatch], seed: int, rate: int, spm_rate: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        data, offsets = text_bytes(part.column("text"))
        ids = part.column("doc_id").to_pylist()
        h = np.array([draws(i, seed) for i in ids], np.int64)
        n, cut1, cut2 = scan_cuts(data, offsets, h[:, 0], h[:, 1])
        held = np.zeros(len(ids), bool)
        for mark in MARKS:
            held |= find_marks(data, offsets, mark) > offsets[:-1]
        plain = held | (np.diff(offsets) == 0) | (h[:, 2] % 100 >= rate) | np.array([i is None for i in ids])
        form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < spm_rate, SPM, PSM))
        out, out_at = scatter(data, offsets, cut1, cut2, form)
        count = lambda a, b: pa.array(_chars(data, a, b), pa.int64(), mask=plain)
        forms = pa.array([FORMS[f] for f in form])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), forms, count(offsets[:-1], cut1), count(cut1, cut2), _strings(out, out_at)],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "output"):
        data, offsets = text_bytes(part.column("output"))
        form = np.array([FORMS.index(f) for f in part.column("form").to_pylist()])
        columns = [part.column(c) for c in part.schema.names]
        yield pa.RecordBatch.from_arrays([*columns, _strings(*gather(data, offsets, form))], [*part.schema.names, "restored"])


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row. ``rate`` of 100
    documents are cut, ``spm_rate`` of 100 of those put the suffix first."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _transform(it, seed, rate, spm_rate), SCHEMA)


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (``output`` and ``form``, no nulls, besides other columns) with the text that
    each was made of, as ``restored``."""
    outputs = outputs.drop("restored")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(_restore, f"{fields}, restored string")


def report(docs: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts restored from them."""
    found = restore(fill_in_middle(docs))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    return found.select(*columns, F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units FROM d),
k AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS b,
        CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm,
        t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM u),
c AS (SELECT *, array_to_string(units[1:least(a, b)], '') AS p, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
        array_to_string(units[greatest(a, b) + 1:], '') AS s FROM k),
o AS (SELECT *, CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END AS output FROM c)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""
