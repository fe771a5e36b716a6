"""Substring dedup by recompression.

Every text is a row of words. Rounds of recompression rename it: a round first names runs of
one symbol, then pairs of neighbours whose left symbol has bit 0 and right symbol bit 1. A name
is a 64-bit fingerprint of what it replaces, so that all tasks give the same part the same name
without a shared dictionary. Each symbol keeps the range of words that decides it (its own and
those of the neighbours which the round looked at). Where that range lies inside a window, the
symbol is interior: any other place with the same window has it too. Of its interior symbols
(those of the highest level that has some) each window takes the one with the smallest name as
its anchor, so that equal windows always meet at equal anchors.

Windows are dealt by anchor, in packed blocks: a run of windows with one anchor carries its name
once, and a 48-bit fingerprint for each window. The window with the smallest (doc_id, position)
stays, others are marked. Before the shuffle the repeats within each slice of a task (4 MB of
texts) are marked and only the first of each is sent, so that a passage that is in a third of all
documents costs a row for each slice.
Marks are then brought to the texts by doc_id.

Windows are equal if anchor name, offset and window fingerprint are (112 bits together).
Null texts have no words. Rows with a null doc_id take no part and stay as they are. Rows that
repeat a doc_id with the same text count once and get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import buckets_of, shuffle_width, slices, text_bytes
from slotflow.llm.hashing import chain, find_words, hash_words, mix, spread

WINDOW = 20
ROUNDS = 2
_BLOCK = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("block", pa.binary())])
_MARKS = pa.schema([("doc_id", pa.int64()), ("marks", pa.binary())])
_FAR = 1 << 40
_RECORD = np.dtype([("name", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("offset", "<i2"), ("n", "<i2")])


def _run_round(name, lo, hi, doc, salt):
    """Runs of one symbol become one; every symbol now depends on both neighbours."""
    inner = doc[1:] == doc[:-1]
    head = np.concatenate(([True], ~(inner & (name[1:] == name[:-1]))))
    first = np.flatnonzero(head)
    last = np.concatenate((first[1:], [len(name)])) - 1
    count = last - first + 1
    new = np.where(count > 1, chain(name[first], count.astype(np.uint64), salt), name[first])
    left = np.concatenate(([False], inner))[first]
    right = np.concatenate((inner, [False]))[last]
    new_lo = np.where(left, lo[np.maximum(first - 1, 0)], -_FAR)
    new_hi = np.where(right, hi[np.minimum(last + 1, len(name) - 1)], _FAR)
    return new, new_lo, new_hi, doc[first]


def _pair_round(name, lo, hi, doc, salt):
    """Neighbours with bits 0 and 1 become one; a symbol left over depends on the neighbour that
    it could have joined."""
    one = (mix(name + np.uint64(salt)) & np.uint64(1)).astype(bool)
    inner = doc[1:] == doc[:-1]
    joins = np.concatenate((inner & ~one[:-1] & one[1:], [False]))
    joined = np.concatenate(([False], joins[:-1]))
    keep = np.flatnonzero(~joined)
    pair = joins[keep]
    after = np.minimum(keep + 1, len(name) - 1)
    before = np.maximum(keep - 1, 0)
    has_after = np.concatenate((inner, [False]))[keep]
    has_before = np.concatenate(([False], inner))[keep]
    new = np.where(pair, chain(name[keep], name[after], salt + 1), name[keep])
    right = one[keep] & ~pair
    new_lo = np.where(right, np.where(has_before, lo[before], -_FAR), lo[keep])
    new_hi = np.where(right, hi[keep], np.where(has_after, hi[after], _FAR))
    return new, new_lo, new_hi, doc[keep]


def _levels(words: np.ndarray, doc: np.ndarray, rounds: int):
    """(name, lo, hi, doc) of the symbols of each level, the words first."""
    at = np.arange(len(words))
    level = (words, at, at + 1, doc)
    yield level
    for k in range(rounds):
        level = _pair_round(*_run_round(*level, salt=101 + 10 * k), salt=102 + 10 * k)
        yield level


def anchors(words: np.ndarray, doc: np.ndarray, valid: np.ndarray, window: int, rounds: int):
    """For each window start in ``valid`` (a mask over words): name and place of its anchor."""
    name = np.zeros(len(words), np.uint64)
    place = np.full(len(words), -1, np.int64)
    for depth, (names, lo, hi, _) in reversed(list(enumerate(_levels(words, doc, rounds)))):
        bare = np.concatenate(([0], np.cumsum(valid & (place < 0))))
        if not bare[-1]:
            break
        start = np.maximum(hi - window, 0)
        use = np.flatnonzero(hi - lo <= window)
        use = use[bare[lo[use] + 1] > bare[start[use]]]
        names, lo, start = mix(names[use] + np.uint64(depth)), lo[use], start[use]
        order = len(names) - 1 - np.argsort(~names[::-1], kind="stable")
        names, lo, start = names[order], lo[order], start[order]
        row, at = spread(lo - start + 1)
        at += start[row]
        new, free = np.full(len(words), -1, np.int64), place < 0
        new[at] = row  # the last one written stays: the smallest name, of equals the leftmost
        free &= new >= 0
        name[free], place[free] = names[new[free]], lo[new[free]]
    return name[valid], place[valid]


def windows(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The fingerprint of the window that starts at each place."""
    value = np.zeros(len(at), np.uint64)
    for k in range(window):
        value = chain(value, words[at + k], 7)
    return value


def _ranges(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of one document as (document, start, count)."""
    head = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)))) if len(at) else np.zeros(0, int)
    return doc[head], at[head], np.diff(np.concatenate((head, [len(at)])))


def _marks(doc_id: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """One row for each document: its marked window starts, packed as ranges."""
    order = np.lexsort((at, doc_id))
    doc, start, count = _ranges(doc_id[order], at[order])
    head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, int)
    packed = np.stack((start, count), 1).astype("<i4")
    ends = np.concatenate((head[1:], [len(doc)]))
    return doc[head], [packed[a:b].tobytes() for a, b in zip(head, ends)]


def _scan(batches: Iterator[pa.RecordBatch], window: int, rounds: int, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of windows by bucket, and (with bucket below 0) marks of repeats within a slice."""
    for part in slices(batches):
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)
        part = part.take(pa.array(np.argsort(ids, kind="stable")))
        ids = np.sort(ids, kind="stable")
        data, offsets = text_bytes(part.column("text"))
        starts, ends, first = find_words(data, offsets)
        words = hash_words(data, starts, ends)
        doc = np.repeat(np.arange(len(ids)), np.diff(first))
        valid = np.arange(len(words)) + window <= first[1:][doc]
        if not valid.any():
            continue
        at = np.flatnonzero(valid)
        name, place = anchors(words, doc, valid, window, rounds)
        print_ = windows(words, at, window)
        row, pos = doc[at], at - first[doc[at]]
        order = np.argsort(print_, kind="stable")
        same = (print_[order][1:] == print_[order][:-1]) & (name[order][1:] == name[order][:-1])
        group = np.cumsum(np.concatenate(([True], ~same))) - 1
        lead = order[np.flatnonzero(np.concatenate(([True], ~same)))][group]  # the first place of the same window
        again = np.zeros(len(at), bool)
        again[order] = (order != lead) & ((ids[row[order]] != ids[row[lead]]) | (pos[order] != pos[lead]))
        if again.any():
            doc_id, packed = _marks(ids[row[again]], pos[again])
            yield pa.RecordBatch.from_arrays([pa.array(-1 - doc_id % n_buckets), pa.array(doc_id), pa.array(packed, pa.binary())], schema=_BLOCK)
        name, place, print_, row, pos, at = (x[~again] for x in (name, place, print_, row, pos, at))
        # one record for a run of windows with one anchor
        head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]))))
        records = np.zeros(len(head), _RECORD)
        records["name"], records["doc"], records["at"] = name[head], ids[row[head]], pos[head]
        records["offset"], records["n"] = (place - at)[head], np.diff(np.concatenate((head, [len(at)])))
        bucket = buckets_of(records["name"], n_buckets)
        order = np.argsort(bucket, kind="stable")
        source, within = spread(records["n"][order].astype(np.int64))
        prints = print_[head[order][source] + within].view(np.uint8).reshape(-1, 8)[:, 2:]
        n_prints = np.concatenate(([0], np.cumsum(records["n"][order], dtype=np.int64)))
        cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0, [True])))
        blocks = []
        for a, b in zip(cut, cut[1:]):
            own = records[order[a:b]]
            doc_steps = np.diff(own["doc"], prepend=0)
            blocks.append(np.int64(b - a).tobytes() + b"".join(x.tobytes() for x in (own["name"], doc_steps, own["at"], own["offset"].astype("<i1"), own["n"].astype("<i1"))) + prints[n_prints[a] : n_prints[b]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[order][cut[:-1]]), pa.array(np.zeros(len(blocks), np.int64)), pa.array(blocks, pa.binary())], schema=_BLOCK)


def _unpack(block: bytes):
    n = int(np.frombuffer(block, "<i8", 1)[0])
    at = 8
    columns = []
    for kind in ("<u8", "<i8", "<i4", "<i1", "<i1"):
        columns.append(np.frombuffer(block, kind, n, at))
        at += n * np.dtype(kind).itemsize
    name, steps, pos, offset, count = columns
    return name, np.cumsum(steps), pos.astype(np.int64), offset.astype(np.int64), count.astype(np.int64), np.frombuffer(block, np.uint8, offset=at).reshape(-1, 6)


def _resolve(blocks: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The windows of one bucket: of equal ones the first stays, the others are marked."""
    parts = [_unpack(b) for b in blocks]
    name, doc, pos, offset, count, prints = (np.concatenate([p[k] for p in parts]) for k in range(6))
    first = np.cumsum(count) - count
    order = np.lexsort((pos, doc))
    row, within = spread(count[order])
    row = order[row]
    wide = np.zeros((len(prints), 8), np.uint8)
    wide[:, 2:] = prints
    finger = wide.view("<u8").ravel()[first[row] + within]
    anchor = chain(name[row], (offset[row] - within).astype(np.uint64), 9)
    doc, pos = doc[row], pos[row] + within
    order = np.lexsort((anchor, finger))
    same = (finger[order][1:] == finger[order][:-1]) & (anchor[order][1:] == anchor[order][:-1])
    head = np.concatenate(([True], ~same))
    lead = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    again = order[(doc[order] != doc[lead]) | (pos[order] != pos[lead])]
    return _marks(doc[again], pos[again])


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Resolves the blocks of a partition, sorted by bucket, one bucket at a time."""
    bucket, blocks = None, []

    def done():
        if blocks:
            doc_id, packed = _resolve(blocks)
            yield pa.RecordBatch.from_arrays([pa.array(doc_id), pa.array(packed, pa.binary())], schema=_MARKS)

    for batch in batches:
        own = batch.column("bucket").to_numpy()
        local = batch.filter(pa.array(own < 0))
        if local.num_rows:
            yield pa.RecordBatch.from_arrays([local.column("doc_id"), local.column("block")], schema=_MARKS)
        for k in np.flatnonzero(own >= 0):
            if own[k] != bucket:
                yield from done()
                bucket, blocks = own[k], []
            blocks.append(batch.column("block")[int(k)].as_py())
    yield from done()


def repeated_windows(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, marks): for each document the starts of its windows that also start earlier, as
    packed (start, count) ranges, in one or more rows."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    n_buckets = 4 * width
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    blocks = docs.mapInArrow(lambda it: _scan(it, window, rounds, n_buckets), "bucket long, doc_id long, block binary")
    dealt = blocks.repartition(width, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_join, "doc_id long, marks binary")


def covered(marks: list[bytes], n_words: int, window: int) -> np.ndarray:
    """Mask of the words that the marked windows cover."""
    ranges = np.frombuffer(b"".join(marks), "<i4").reshape(-1, 2).astype(np.int64)
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, ranges[:, 0], 1)
    np.add.at(change, np.minimum(ranges[:, 0] + ranges[:, 1] + window - 1, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def _strip(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, marks in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "marks"))):
            words = text.encode().split() if text else []
            kept = words
            if marks:
                gone = covered(marks, len(words), window)
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row of ``docs`` with the words joined by one
    space that no repeated window covers."""
    marks = repeated_windows(docs, window, rounds).groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))
    joined = docs.select("doc_id", "text").join(marks, "doc_id", "left")
    return joined.mapInArrow(lambda it: _strip(it, window), "doc_id long, n_words long, n_removed long, kept string")


def digest(frame: DataFrame) -> DataFrame:
    return frame.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
