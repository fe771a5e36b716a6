"""Token ids as binary shard files with a minimal perfect hash index.

Writing. Documents are range-partitioned and sorted by doc_id (rows of one doc_id by a digest of
their text), encoded, and written by each task as shard files of about ``SHARD`` bytes of ids (a
longer document is a shard of its own), in that order. A file is written under a hidden name and
then moved to its own name, which depends on the partition and the place only: a task that runs
again writes the same bytes to the same names, so a lost executor loses nothing and a shard is never
seen half written. Files are written with Arrow's file systems (local or mounted paths, s3, gs,
hdfs, abfs), the table of shards by Spark.

A shard file is, in little-endian order: ``_HEAD``, then the index, then the ids, raw, as 16-bit
integers if the vocabulary fits, else 32-bit.

- Index: a minimal perfect hash of the shard's distinct doc_ids. Level by level, keys hash into a
  bit array twice their number; those alone on their bit are placed, the rest go down a level. A
  key's slot is the number of bits before its own, from counts kept for each 64-bit word. Of each
  slot the file has a 32-bit fingerprint of its key, its first row and its number of rows (several
  if a doc_id repeats). Of each row it has the doc_id and where its ids end.
- Access by key: ``Shard.find`` probes a level or two, rejects keys that are not there by their
  fingerprints (and by the doc_id of the row, as fingerprints may meet), and slices the ids: the
  time does not depend on the number of keys.

Null texts are empty. Rows with a null doc_id come first; they can be read in order, not by key.
Only doc_id and text are read.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.llm.common import shuffle_width, slices
from slotflow.llm.encoding import encoder
from slotflow.llm.hashing import mix

SHARD = 4 << 20
LEVELS = 40
#: magic, bytes of an id, partition, ids of the partition before this shard, rows, rows without a
#: key, keys, keys that no level could place, levels, ids
_HEAD = struct.Struct("<8s9Q")
_MAGIC = b"IDSHARD1"
_MANIFEST = "part long, shard long, file string, first_doc long, last_doc long, n_rows long, n_ids long"


# ------------------------------------------------------------------ minimal perfect hash
def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mix(keys ^ mix(np.full(len(keys), level + 1, np.uint64))) % np.uint64(bits)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct unsigned 64-bit keys."""

    def __init__(self, words: list[np.ndarray], rest: np.ndarray):
        self.words, self.rest = words, rest
        bits = np.bitwise_count(np.concatenate([np.zeros(0, np.uint64), *words])).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(bits)))  # bits before each word

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words = []
        for level in range(LEVELS):
            if not len(keys):
                break
            size = -(-2 * len(keys) // 64)
            place = _places(keys, level, 64 * size)
            alone = np.bincount(place.astype(np.int64), minlength=64 * size)[place] == 1
            own = np.zeros(size, np.uint64)
            np.bitwise_or.at(own, (place[alone] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place[alone] & np.uint64(63)))
            words.append(own)
            keys = keys[~alone]
        return cls(words, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for keys that were not built in."""
        out = np.full(len(keys), -1)
        left, start = np.arange(len(keys)), 0
        for level, own in enumerate(self.words):
            if not len(left):
                return out
            place = _places(keys[left], level, 64 * len(own))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (own[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(own[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[start + word] + below)[hit]
            left, start = left[~hit], start + len(own)
        at = np.searchsorted(self.rest, keys[left])
        there = at < len(self.rest)
        there[there] = self.rest[at[there]] == keys[left][there]
        out[left[there]] = self.before[-1] + at[there]
        return out


# ------------------------------------------------------------------ one shard
def pack_shard(part: int, before: int, docs: list[int | None], ends: list[int], ids: bytes, wide: int) -> bytes:
    """A shard file. ``docs`` are sorted, nulls first; ``ends`` count ids; ``ids`` are 32-bit."""
    n_null = sum(d is None for d in docs)
    keys = np.array(docs[n_null:], np.int64)
    own, first, count = np.unique(keys, return_index=True, return_counts=True)
    table = PerfectHash.build(own.view(np.uint64))
    slots = table.slots(own.view(np.uint64))
    marks, row, rows = np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4")
    marks[slots], row[slots], rows[slots] = fingerprints(own.view(np.uint64)), first + n_null, count
    payload = np.frombuffer(ids, "<u4").astype(f"<u{wide}")
    head = _HEAD.pack(_MAGIC, wide, part, before, len(docs), n_null, len(own), len(table.rest), len(table.words), len(payload))
    sizes = np.array([len(w) for w in table.words], "<u8")
    body = [sizes, *(w.astype("<u8") for w in table.words), table.rest.astype("<u8"), np.array(ends, "<u8"), keys.astype("<i8"), marks, row, rows, payload]
    return head + b"".join(b.tobytes() for b in body)


class Shard:
    """A shard file's bytes (or a memory map of it)."""

    def __init__(self, data):
        magic, wide, self.part, self.before, self.n_rows, self.n_null, n_keys, n_rest, n_levels, n_ids = _HEAD.unpack_from(data, 0)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        words = [take("<u8", int(n)) for n in take("<u8", n_levels)]
        self.table = PerfectHash(words, take("<u8", n_rest))
        self.ends, self.docs = take("<u8", self.n_rows).astype(np.int64), take("<i8", self.n_rows - self.n_null)
        self.marks, self.row, self.rows = take("<u4", n_keys), take("<u4", n_keys), take("<u4", n_keys)
        self.ids = take(f"<u{wide}", n_ids)

    def span(self, row: int) -> tuple[int, int]:
        return (int(self.ends[row - 1]) if row else 0), int(self.ends[row])

    def find(self, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each doc_id; no rows if the shard does not hold it."""
        keys = np.asarray(doc_ids, np.int64)
        slot = self.table.slots(keys.view(np.uint64))
        held = slot >= 0
        held[held] = self.marks[slot[held]] == fingerprints(keys[held].view(np.uint64))
        held[held] = self.docs[self.row[slot[held]].astype(np.int64) - self.n_null] == keys[held]
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[held], count[held] = self.row[slot[held]], self.rows[slot[held]]
        return first, count

    def get(self, doc_id: int) -> list[np.ndarray]:
        """The ids of each row with this doc_id."""
        first, count = (int(x[0]) for x in self.find(np.array([doc_id])))
        return [self.ids[slice(*self.span(r))] for r in range(first, first + count)]


# ------------------------------------------------------------------ writing
def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, limit: int) -> Iterator[pa.RecordBatch]:
    encode, part = encoder(path), TaskContext.get().partitionId()
    wide = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    docs, ends, ids, size, n_shards, before = [], [], [], 0, 0, 0

    def done() -> pa.RecordBatch:
        name = f"part-{part:06d}-{n_shards:06d}.ids"
        hidden = posixpath.join(root, f"_{name}-{TaskContext.get().taskAttemptId()}")
        with fs.open_output_stream(hidden, compression=None) as out:
            out.write(pack_shard(part, before, docs, ends, b"".join(ids), wide))
        fs.move(hidden, posixpath.join(root, name))
        keyed = [d for d in docs if d is not None] or [None]
        row = (part, n_shards, name, keyed[0], keyed[-1], len(docs), size // 4)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [c.split()[0] for c in _MANIFEST.split(", ")])

    for piece in slices(batches):
        for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
            own = encode.ids(text or "") + end
            if docs and size + len(own) > limit:
                yield done()
                before, n_shards = before + size // 4, n_shards + 1
                docs, ends, ids, size = [], [], [], 0
            docs.append(doc_id)
            ids.append(own)
            size += len(own)
            ends.append(size // 4)
    if docs:
        yield done()


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = 1, limit: int = SHARD) -> DataFrame:
    """Writes the ids of every row's text, each with ``end_id`` behind, as shard files under
    ``folder`` (new, shared) in ascending order of doc_id, ``limit`` bytes of 32-bit ids to a file.
    Returns the table of shards."""
    width = shuffle_width(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(width, *by).sortWithinPartitions(*by)
    ids = f"{folder.rstrip('/')}/ids"
    dealt.mapInArrow(lambda it: _write(it, ids, path, end_id, limit), _MANIFEST).write.parquet(f"{folder.rstrip('/')}/shards")
    return shards_of(docs.sparkSession, folder)


def shards_of(spark: SparkSession, folder: str) -> DataFrame:
    """The table of shards: partition, place in it, file, keys from and to, rows and ids."""
    return spark.read.schema(_MANIFEST).parquet(f"{folder.rstrip('/')}/shards")


# ------------------------------------------------------------------ reading
def _starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """The ids before each partition of the writer (a row for each)."""
    sizes = {r["part"]: r["n"] for r in shards_of(spark, folder).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    out, before = {}, 0
    for part in sorted(sizes):
        out[part], before = before, before + sizes[part]
    return out


def _read(batches: Iterator[pa.RecordBatch], starts: dict[int, int], keys: list[int] | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            shard = Shard(content.as_buffer())
            wanted = np.unique(shard.docs) if keys is None else np.array(keys, np.int64)
            first, count = shard.find(wanted)
            docs = [None] * (shard.n_null if keys is None else 0) + np.repeat(wanted, count).tolist()
            rows = [*range(len(docs) - int(count.sum())), *(r for f, c in zip(first.tolist(), count.tolist()) for r in range(f, f + c))]
            spans = [shard.span(r) for r in rows]
            base = starts[shard.part] + shard.before
            columns = [pa.array(docs, pa.int64()), pa.array([base + a for a, _ in spans], pa.int64()), pa.array([b - a for a, b in spans], pa.int64())]
            raw = shard.ids.astype("<u4")
            if with_ids:
                kind = pa.list_(pa.int64())
                columns.append(pa.array([raw[a:b].astype(np.int64) for a, b in spans], kind))
            else:
                columns.append(pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids" if with_ids else "ids_crc32"])


def _files(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(names).select("content")


def read_shards(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every row of the files, each found through its shard's
    index: ``start`` counts the ids before it in all files. Without ids: their crc32."""
    last, starts = ("ids array<long>" if with_ids else "ids_crc32 long"), _starts(spark, folder)
    if not starts:
        return spark.createDataFrame([], f"doc_id long, start long, n_tokens long, {last}")
    return _files(spark, [f"{folder.rstrip('/')}/ids"]).mapInArrow(lambda it: _read(it, starts, None, with_ids), f"doc_id long, start long, n_tokens long, {last}")


def lookup(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the rows with the given doc_ids (a short list). Only files
    whose range holds a key are read."""
    keys = sorted(set(keys))
    some = shards_of(spark, folder).where(F.exists(F.lit(keys).cast("array<long>"), lambda k: (F.col("first_doc") <= k) & (k <= F.col("last_doc")))) if keys else None
    names = [f"{folder.rstrip('/')}/ids/{r['file']}" for r in some.select("file").collect()] if keys else []  # at most a few for each key
    schema = "doc_id long, start long, n_tokens long, ids array<long>"
    if not names:
        return spark.createDataFrame([], schema)
    starts = _starts(spark, folder)
    return _files(spark, names).mapInArrow(lambda it: _read(it, starts, keys, True), schema)


def report(docs: DataFrame, path: str, folder: str, limit: int = SHARD) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from its files."""
    write_shards(docs, path, folder, limit=limit)
    return read_shards(docs.sparkSession, folder, with_ids=False)
