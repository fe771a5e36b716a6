"""Exact Jaccard join on word shingles, by components.

The Jaccard distance is a metric, and a link needs a distance of at most e = 1 - percent / 100.

1. Regions. In the whole space unrelated texts lie at distance 1 from any pivot, so pivots taken
   from the documents split nothing there. The shingle space is therefore halved by hash again
   and again: of two linked sets, some half is linked too (the ratio of the sums is no larger
   than the largest ratio), so a link survives down one path. Once a part is so small that two
   different sets are over e apart (at most u shingles, 9 at 90 percent), each distinct set is a
   pivot and its region holds that set alone: both documents meet there. Parts of exactly u
   shingles lie on the border (a set with u + 1 may be within e) and go down as well.
   Meeting documents form candidate components ("regions"), found by star contraction. Where u is
   small (below ``SURE`` shingles; 4 at 80 percent), texts that share no more than a passage meet
   too, and would chain into one component. There each meeting is first checked in another
   space: a set is folded to counts of ``next power of 2 of n / 4`` hash classes. The weighted
   Jaccard distance of the counts is never larger than the distance of the sets, so that sets
   over e apart in the folded space need no edge, and nothing that links is lost.
2. Regions join exactly, each within a task: a pivot is compared with all sets whose size and
   distances to earlier pivots allow a distance of 2e (triangle inequality). Sets within e are
   its ball and linked; those within 2e of it are compared with the ball's members in their
   window; the rest goes on recursively with a new pivot.
3. Regions beyond ``MAX_REGION`` sets are split first: their sets are placed by their distances
   to several pivots and linked to those within e; then only sets outside the region's largest
   component are compared, in blocks, with the sets of other components in their window.

Equal sets count once throughout (one representative moves, found by a 128-bit digest of the
set). Within a slice of the scan, and again in each task where regions meet, sets that
share regions are joined on the spot: each gives one link, to the smallest that it reaches there,
so that a hot region costs a row for each slice. Null or empty texts have no shingles and link
with nothing; a null doc_id gets a null component. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from slotflow.llm.common import buckets_of, shuffle_width, slices, stage, text_bytes
from slotflow.llm.graph import components, smallest_reached
from slotflow.llm.hashing import chain, find_words, hash_words, mix

MAX_REGION = 2000
SURE = 8
PIVOTS = 16
_BLOCK = pa.schema([("bucket", pa.int64()), ("block", pa.binary())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# ------------------------------------------------------------------ sets
def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the distinct shingles of each row, sorted. Rows with fewer words than
    ``size`` have one shingle, rows without words none."""
    starts, ends, first = find_words(data, offsets)
    words = hash_words(data, starts, ends, lower=True)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    at = np.flatnonzero(np.arange(len(words)) + size <= first[1:][doc])
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value = chain(value, words[at + k], 3)
    whole = n_words[short].astype(np.uint64)
    for k in range(size - 1):
        has = n_words[short] > k
        whole[has] = chain(whole[has], words[first[short][has] + k], 5)
    row, value = np.concatenate((doc[at], short)), np.concatenate((value, whole))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))[: len(row)]
    return row[new], value[new]


def smallest_difference(percent: int) -> int:
    """The largest u for which two different sets with u shingles together cannot link."""
    return -(-100 // (100 - percent)) - 1


def regions_of(row: np.ndarray, value: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the regions that each row's set belongs to."""
    limit = smallest_difference(percent)
    out_row, out_key = [], []
    for depth in range(64):
        if not len(row):
            break
        part = value >> np.uint64(64 - depth) if depth else np.zeros(len(value), np.uint64)
        head = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (part[1:] != part[:-1]))))
        count = np.diff(np.concatenate((head, [len(row)])))
        small = count <= limit
        if small.any():
            total = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), head)
            out_row.append(row[head[small]])
            out_key.append(chain(total[small], part[head[small]], 1000 + depth))
        down = np.repeat(count >= limit, count)
        row, value = row[down], value[down]
    if not out_row:
        return np.zeros(0, int), np.zeros(0, np.uint64)
    return np.concatenate(out_row), np.concatenate(out_key)


def digest_of(row: np.ndarray, value: np.ndarray, n_rows: int, salt: int) -> np.ndarray:
    """A 64-bit digest of each row's set."""
    n = np.bincount(row, minlength=n_rows)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(salt)), dtype=np.uint64)))
    ends = np.cumsum(n)
    return (total[ends] - total[ends - n]).view(np.int64)


def _digests(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        row, value = shingle_sets(*text_bytes(part.column("text")), size)
        n = np.bincount(row, minlength=part.num_rows)
        sums = [digest_of(row, value, part.num_rows, salt) for salt in (11, 13)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(sums[0]), pa.array(sums[1])], ["doc_id", "n_shingles", "d1", "d2"])


def set_digests(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2) of every row: the size and a 128-bit digest of its set."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _digests(it, size), "doc_id long, n_shingles long, d1 long, d2 long")


# ------------------------------------------------------------------ candidate regions
def _edges(key: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Members that share a key, directly or over others, are one: for each key the smallest member
    that its members reach, and a link to that from each other member, once."""
    order = np.lexsort((member, key))
    key, member = key[order], member[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    least = member[head]
    nodes, root = smallest_reached(member, np.repeat(least, np.diff(np.concatenate((head, [len(key)])))))
    child = nodes != root
    return key[head], root[np.searchsorted(nodes, least)], nodes[child], root[child]


def _scan(batches: Iterator[pa.RecordBatch], size: int, percent: int, n_buckets: int, reduce: bool = True) -> Iterator[pa.RecordBatch]:
    """Regions and their members by bucket. ``reduce``: members are digests of sets, so that copies
    are one, and of a region only the smallest leaves a slice, besides links to it."""
    for part in slices(batches):
        sets = shingle_sets(*text_bytes(part.column("text")), size)
        ids = digest_of(*sets, part.num_rows, 11) if reduce else part.column("doc_id").to_numpy(zero_copy_only=False)
        row, key = regions_of(*sets, percent)
        if not len(row):
            continue
        doc = ids[row]
        if reduce:
            key, doc, a, b = _edges(key, doc)
        else:
            a = b = ()
        buckets, blocks = [], []
        if len(a):
            buckets.append(-1 - int(a[0]) % n_buckets)
            blocks.append(np.stack((a, b), 1).astype("<i8").tobytes())
        bucket = buckets_of(key, n_buckets)
        order = np.lexsort((doc, bucket))
        cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0, [True])))
        for s, e in zip(cut, cut[1:]):
            own = order[s:e]
            buckets.append(int(bucket[own[0]]))
            blocks.append(key[own].tobytes() + np.diff(doc[own], prepend=0).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blocks, pa.binary())], schema=_BLOCK)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, blocks = None, []

    def done():
        if blocks:
            halves = [np.frombuffer(b, "<u8") for b in blocks]
            key = np.concatenate([h[: len(h) // 2] for h in halves])
            doc = np.concatenate([np.cumsum(h[len(h) // 2 :].view("<i8")) for h in halves])
            _, _, a, b = _edges(key, doc)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_EDGE)

    for batch in batches:
        for k, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist()):
            if k < 0:
                pairs = np.frombuffer(block, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_EDGE)
                continue
            if k != bucket:
                yield from done()
                bucket, blocks = k, []
            blocks.append(block)
    yield from done()


# ------------------------------------------------------------------ meetings checked by folded sets
def fold_set(value: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by hash class. A class holds four on average at most, so a byte
    is ample."""
    classes = 16
    while classes < len(value) / 4:
        classes *= 2
    return np.bincount((value & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8)


def _half(rows: np.ndarray) -> np.ndarray:
    """Counts in half as many classes."""
    return rows[:, : rows.shape[1] // 2] + rows[:, rows.shape[1] // 2 :]


def check_meeting(n: np.ndarray, folded: list[np.ndarray], percent: int) -> np.ndarray:
    """For the sets of one meeting, the smallest index that each reaches by pairs that are near
    enough in the folded space. Pairs that a path joins already are not compared."""
    label = np.arange(len(n))
    width = np.array([len(f) for f in folded])
    table = {int(w): np.stack([f for f in folded if len(f) == w]).astype(np.int32) for w in np.unique(width)}
    place = np.zeros(len(n), np.int64)
    for w in table:
        place[width == w] = np.arange((width == w).sum())
    halves = {w: _half(t) for w, t in table.items()}
    for i in range(len(n) - 1):
        other = np.arange(i + 1, len(n))
        other = other[(label[other] != label[i]) & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
        own = table[int(width[i])][place[i]]
        for w, rows, mine in ((width[i], table, own), (2 * width[i], halves, own), (width[i] // 2, table, _half(own[None])[0])):
            some = other[width[other] == w]
            if not len(some):
                continue
            common = np.minimum(rows[int(w)][place[some]], mine).sum(1)
            near = some[(100 + percent) * common >= percent * (n[some] + n[i])]
            if len(near):
                joined = np.unique(np.append(label[near], label[i]))
                label[np.isin(label, joined)] = joined[0]
    return label


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(meeting, members) of the regions of each bucket that several documents share; regions of
    the same documents are one meeting."""
    bucket, blocks = None, []

    def done():
        if not blocks:
            return
        halves = [np.frombuffer(b, "<u8") for b in blocks]
        key = np.concatenate([h[: len(h) // 2] for h in halves])
        doc = np.concatenate([np.cumsum(h[len(h) // 2 :].view("<i8")) for h in halves])
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
        key, doc = key[new], doc[new]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.concatenate((head, [len(key)])))
        meeting = mix(np.add.reduceat(mix(doc.astype(np.uint64)), head) + count.astype(np.uint64))
        some = np.flatnonzero(count > 1)
        meeting, which = np.unique(meeting[some], return_index=True)
        members = [doc[head[k] : head[k] + count[k]].astype("<i8").tobytes() for k in some[which]]
        yield pa.RecordBatch.from_arrays([pa.array(meeting.view(np.int64)), pa.array(members, pa.binary())], ["meeting", "members"])

    for batch in batches:
        for k, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist()):
            if k != bucket:
                yield from done()
                bucket, blocks = k, []
            blocks.append(block)
    yield from done()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = [np.frombuffer(m, "<i8") for m in batch.column("members").to_pylist()]
        if docs:
            meeting = np.repeat(batch.column("meeting").to_numpy(), [len(d) for d in docs])
            yield pa.RecordBatch.from_arrays([pa.array(meeting), pa.array(np.concatenate(docs))], ["meeting", "doc_id"])


def _folds(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        row, value = shingle_sets(*text_bytes(part.column("text")), size)
        own = np.split(value, np.searchsorted(row, np.arange(1, part.num_rows)))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(v) for v in own]), pa.array([fold_set(v).tobytes() for v in own], pa.binary())], ["doc_id", "n", "folded"])


def _check(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges of the meetings of a partition, which is sorted by meeting and doc_id."""
    meeting, ids, n, folded, a, b = None, [], [], [], [], []

    def done():
        if len(ids) > 1:
            doc, label = np.array(ids), check_meeting(np.array(n), folded, percent)
            joined = label != np.arange(len(doc))
            a.extend(doc[joined].tolist())
            b.extend(doc[label[joined]].tolist())

    for batch in batches:
        for m, doc, size, counts in zip(*(batch.column(c).to_pylist() for c in ("meeting", "doc_id", "n", "folded"))):
            if m != meeting:
                done()
                meeting, ids, n, folded = m, [], [], []
            ids.append(doc)
            n.append(size)
            folded.append(np.frombuffer(counts, np.uint8))
        pairs = list(dict.fromkeys(zip(a, b)))
        a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=_EDGE)
    done()
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)


def checked_edges(docs: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) like ``candidate_edges``, between representatives (``doc_id``) only, and only along
    pairs that are near enough in the folded space."""
    width = shuffle_width(docs.sparkSession)
    n_buckets = 4 * width
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    blocks = docs.mapInArrow(lambda it: _scan(it, size, percent, n_buckets, False), "bucket long, block binary")
    groups = blocks.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(_group, "meeting long, members binary")
    meetings = stage(groups.dropDuplicates(["meeting"]), "meetings")
    members = meetings.mapInArrow(_members, "meeting long, doc_id long").join(reps, "doc_id", "left_semi")
    folds = stage(docs.mapInArrow(lambda it: _folds(it, size), "doc_id long, n long, folded binary").where("n > 0"), "folds")
    placed = members.join(folds, "doc_id").repartition(width, "meeting").sortWithinPartitions("meeting", "doc_id")
    return placed.select("meeting", "doc_id", "n", "folded").mapInArrow(lambda it: _check(it, percent), "a long, b long")


def candidate_edges(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links from sets (their digests ``d1``) to the smallest set of a region that they
    share. Sets that are linked are joined by a path of these; two sets of one digest count as one
    node here, which only makes a region larger."""
    width = shuffle_width(docs.sparkSession)
    n_buckets = 4 * width
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    blocks = docs.mapInArrow(lambda it: _scan(it, size, percent, n_buckets), "bucket long, block binary")
    dealt = blocks.repartition(width, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_meet, "a long, b long")


# ------------------------------------------------------------------ exact join within a region
class _Sets:
    """Sets as one sorted array each; ``shared`` compares one with many at once."""

    def __init__(self, values: list[np.ndarray], percent: int):
        self.sizes = np.array([len(v) for v in values])
        self.values, self.percent = values, percent
        self.parent = np.arange(len(values))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return int(x)

    def union(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        own = self.values[x]
        many = np.concatenate([self.values[o] for o in others])
        hit = own[np.minimum(np.searchsorted(own, many), len(own) - 1)] == many
        return np.add.reduceat(hit, np.cumsum(self.sizes[others]) - self.sizes[others], dtype=np.int64)

    def links(self, x: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether x links with each, exactly, and their distances."""
        common = self.shared(x, others)
        union = self.sizes[x] + self.sizes[others] - common
        return 100 * common >= self.percent * union, 1 - common / union

    def near_size(self, x: int, others: np.ndarray, distance: float) -> np.ndarray:
        small, large = np.minimum(self.sizes[others], self.sizes[x]), np.maximum(self.sizes[others], self.sizes[x])
        return others[small >= (1 - distance) * large - 1e-9]


def join_region(values: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the smallest index that its links reach, within this region."""
    sets, e = _Sets(values, percent), 1 - percent / 100
    rest = np.arange(len(values))
    placed: list[np.ndarray] = []  # distances to earlier pivots; nan where not measured
    while len(rest) > 1:
        pivot, rest = int(rest[0]), rest[1:]
        near = sets.near_size(pivot, rest, 2 * e)
        for known in placed[-PIVOTS:]:
            near = near[~(np.abs(known[near] - known[pivot]) > 2 * e + 1e-9)]
        if not len(near):
            continue
        linked, distance = sets.links(pivot, near)
        known = np.full(len(values), np.nan)
        known[near], known[pivot] = distance, 0
        placed.append(known)
        ball = near[linked]
        for x in ball:
            sets.union(pivot, int(x))
        for y in near[~linked & (distance <= 2 * e + 1e-9)]:
            if not len(ball) or sets.root(int(y)) == sets.root(pivot):
                continue
            window = sets.near_size(int(y), ball[known[ball] >= known[y] - e - 1e-9], e)
            if len(window) and sets.links(int(y), window)[0].any():
                sets.union(pivot, int(y))
        rest = rest[~np.isin(rest, ball)]
    return np.array([sets.root(i) for i in range(len(values))])


def _join(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, root) for the regions of a partition, which is sorted by region and doc_id."""
    region, ids, values = None, [], []

    def done():
        if len(ids) > 1:
            root = join_region(values, percent)
            doc = np.array(ids)
            linked = root != np.arange(len(doc))
            return doc[linked], doc[root[linked]]
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    for part in slices(batches):
        row, value = shingle_sets(*text_bytes(part.column("text")), size)
        own = np.split(value, np.searchsorted(row, np.arange(1, part.num_rows)))
        found = []
        for r, doc, v in zip(part.column("region").to_pylist(), part.column("doc_id").to_pylist(), own):
            if r != region:
                found.append(done())
                region, ids, values = r, [], []
            if not ids or ids[-1] != doc:
                ids.append(doc)
                values.append(v)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], schema=_EDGE)
    last = done()
    yield pa.RecordBatch.from_arrays([pa.array(last[0]), pa.array(last[1])], schema=_EDGE)


# ------------------------------------------------------------------ regions too large for a task
def _to_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        row, value = shingle_sets(*text_bytes(part.column("text")), size)
        packed = [v.tobytes() for v in np.split(value, np.searchsorted(row, np.arange(1, part.num_rows)))]
        yield pa.RecordBatch.from_arrays([part.column("region"), part.column("doc_id"), pa.array(packed, pa.binary())], ["region", "doc_id", "items"])


def _place(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The distances of each set to its region's pivots, and the nearest pivot within e."""
    for part in slices(batches, "items"):
        out = []
        for region, doc, items, pivots in zip(*(part.column(c).to_pylist() for c in ("region", "doc_id", "items", "pivots"))):
            pivots = sorted(pivots, key=lambda p: p["doc_id"])
            sets = _Sets([np.frombuffer(items, "<u8"), *(np.frombuffer(p["items"], "<u8") for p in pivots)], percent)
            linked, distance = sets.links(0, np.arange(1, len(pivots) + 1))
            home = pivots[int(np.flatnonzero(linked)[np.argmin(distance[linked])])]["doc_id"] if linked.any() else doc
            out.append((region, doc, items, distance.tolist(), home))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["region", "doc_id", "items", "place", "home"])


def _cross(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the two sides of each block pair, across components."""
    e, key, sides = 1 - percent / 100, None, {True: [], False: []}

    def done():
        left, right = sides[True], sides[False]
        a, b = [], []
        if left and right:
            sets = _Sets([np.frombuffer(r["items"], "<u8") for r in left + right], percent)
            place = np.array([r["place"] for r in left + right])
            comp = np.array([r["comp"] for r in left + right])
            others = np.arange(len(left), len(left) + len(right))
            for x in range(len(left)):
                near = others[(comp[others] != comp[x]) & (np.abs(place[others] - place[x]).max(1) <= e + 1e-9)]
                near = sets.near_size(x, near, e)
                if len(near):
                    for y in near[sets.links(x, near)[0]]:
                        a.append(left[x]["doc_id"])
                        b.append(right[int(y) - len(left)]["doc_id"])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)

    for batch in batches:
        for r in batch.to_pylist():
            if (now := (r["region"], r["i"], r["j"])) != key:
                yield done()
                key, sides = now, {True: [], False: []}
            sides[r["minor"]].append(r)
    yield done()


def _large_regions(texts: DataFrame, size: int, percent: int, max_region: int) -> DataFrame:
    """(a, b) links of the regions in ``texts`` (region, doc_id, n_region, text): pivots first,
    then blocks of what lies outside the largest component against the rest."""
    width = shuffle_width(texts.sparkSession)
    sets = stage(texts.mapInArrow(lambda it: _to_sets(it, size), "region long, doc_id long, items binary").dropDuplicates(["doc_id"]), "sets")
    by_hash = Window.partitionBy("region").orderBy(F.xxhash64("doc_id"), "doc_id")
    pivots = sets.select("region", "doc_id", "items").withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= PIVOTS)
    pivots = pivots.groupBy("region").agg(F.collect_list(F.struct("doc_id", "items")).alias("pivots"))
    placed = sets.join(pivots, "region").mapInArrow(lambda it: _place(it, percent), "region long, doc_id long, items binary, place array<double>, home long")
    placed = stage(placed, "placed")
    first = components(placed.select(F.col("doc_id").alias("a"), F.col("home").alias("b")))
    placed = placed.join(first.select(F.col("node").alias("doc_id"), F.col("root").alias("comp")), "doc_id")
    counts = placed.groupBy("region", "comp").agg(F.count("*").alias("n"))
    largest = counts.groupBy("region").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("major"), F.sum("n").alias("n_all"))
    per_block = max_region
    joined = placed.join(largest, "region").withColumn("minor", F.col("comp") != F.col("major"))
    n_minor = joined.where("minor").groupBy("region").agg(F.count("*").alias("n_minor"))
    joined = joined.join(n_minor, "region")
    blocks_minor = F.ceil(F.col("n_minor") / per_block).cast("int")
    blocks_all = F.ceil(F.col("n_all") / per_block).cast("int")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    columns = ["region", "doc_id", "items", "place", "comp"]
    left = joined.where("minor").select(*columns, own(blocks_minor).alias("i"), F.explode(F.sequence(F.lit(0), blocks_all - 1)).alias("j"), F.lit(True).alias("minor"))
    right = joined.select(*columns, F.explode(F.sequence(F.lit(0), blocks_minor - 1)).alias("i"), own(blocks_all).alias("j"), F.lit(False).alias("minor"))
    pairs = left.unionByName(right).repartition(width, "region", "i", "j").sortWithinPartitions("region", "i", "j")
    crossed = pairs.mapInArrow(lambda it: _cross(it, percent), "a long, b long")
    return crossed.unionByName(first.select(F.col("node").alias("a"), F.col("root").alias("b")))


# ------------------------------------------------------------------ the operator
def near_components(docs: DataFrame, size: int = 5, percent: int = 80, max_region: int = MAX_REGION) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents link when
    100 * intersection >= percent * union of their sets of ``size``-word shingles (A-Z taken as
    a-z), and component_id is the smallest doc_id that links reach."""
    width = shuffle_width(docs.sparkSession)
    sets = stage(set_digests(docs, size), "sets")
    same = ["n_shingles", "d1", "d2"]
    classes = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stage(classes, "classes")
    if smallest_difference(percent) >= SURE:
        regions = components(candidate_edges(docs, size, percent)).withColumnRenamed("node", "d1").join(classes.select("d1", "rep"), "d1")
    else:
        reps = classes.select(F.col("rep").alias("doc_id"))
        regions = components(checked_edges(docs, reps, size, percent)).withColumnRenamed("node", "rep").join(classes.select("rep"), "rep", "left_semi")
    members = regions.select(F.col("rep").alias("doc_id"), F.col("root").alias("region"))
    counts = members.groupBy("region").agg(F.count("*").alias("n_region")).where("n_region > 1")
    members = stage(members.join(counts, "region").select("doc_id", "region", "n_region"), "members")
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").join(members.hint("merge"), "doc_id")
    small = texts.where(F.col("n_region") <= max_region).repartition(width, "region").sortWithinPartitions("region", "doc_id")
    links = small.select("region", "doc_id", "text").mapInArrow(lambda it: _join(it, size, percent), "a long, b long")
    if members.where(F.col("n_region") > max_region).limit(1).count():
        large = _large_regions(texts.where(F.col("n_region") > max_region), size, percent, max_region)
        links = links.unionByName(components(large).where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = links.select(F.col("a").alias("rep"), F.col("b").alias("linked"))
    found = stage(classes.join(links, "rep", "left").select(*same, "copies", F.coalesce("linked", "rep").alias("component")), "components")
    return _to_documents(sets, found, same).select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _to_documents(sets: DataFrame, found: DataFrame, same: list[str]) -> DataFrame:
    """``sets`` with the component of their class. Classes with more than a share of all rows (at
    most ``4 * width`` of them) are broadcast, so that no task gets all copies of a text."""
    share = max(2, sets.count() // (4 * shuffle_width(sets.sparkSession)))
    hot = found.where(F.col("copies") > share).select(*same, F.col("component").alias("hot"))
    marked = sets.join(F.broadcast(hot), same, "left")
    rest = marked.where("hot IS NULL").drop("hot").join(found.where(F.col("copies") <= share).drop("copies"), same, "left")
    return marked.where("hot IS NOT NULL").withColumnRenamed("hot", "component").unionByName(rest)


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those that a document of smaller doc_id reaches by links."""
    found = near_components(docs, size, percent).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found.hint("merge"), "doc_id", "left_anti").select(docs.columns)
