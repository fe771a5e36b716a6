"""Connected components of an edge table on executors only.

An edge (a, b), a > b, says that a belongs to b. Each round deals every edge to the task of a and
to that of b, so that an edge meets the others of its larger end and the edge that leads on from its
smaller one. A task joins what it holds (numpy, whole blocks at once) and gives each node's edge to
the smallest node that it reaches there; paths shrink to half and less. The rounds end when no task
changed an edge: each node then has one edge, to its component's smallest node.

A node has at most one edge from each task as the larger end. As the smaller end it may have any
number (the smallest of a large component has them all). So each task also reports the ``TOP`` nodes
to which it gave most edges, if they have a 1024th of them; nodes that have more than a share of
all by these reports are hubs, and their edges are dealt over several tasks, each with a copy of the
hub's own edges. The first round, before any report, deals edges to their larger ends only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from slotflow.llm.common import shuffle_width, stage

BLOCK = 1 << 21
TOP = 32
ROWS = 1 << 16  # rows that are worth a task
_STARS = "a long, b long, moved boolean, n long"


def smallest_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that the edges name, sorted, and the smallest that each reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        if (low == high).all():
            return nodes, nodes[parent]
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, moved) for the edges of a partition, which is sorted by key, and (null, b, false, n)
    for the nodes with most of them."""
    held: list[np.ndarray] = []

    def done(rows: np.ndarray) -> pa.RecordBatch:
        key, a, b = rows
        nodes, root = smallest_reached(a, b)
        # an edge that stays is given out by the task of its larger end; what changed, by any
        own = np.unique(a[key == a])
        edges = np.unique(np.stack((a, b), 1), axis=0)
        after = root[np.searchsorted(nodes, edges[:, 0])]
        child = nodes != root
        known = np.zeros(len(nodes), bool)
        known[np.searchsorted(nodes, edges[after == edges[:, 1], 0])] = True
        give = child & (~known | np.isin(nodes, own))
        changed = np.isin(nodes[give], edges[after != edges[:, 1], 0]) | ~known[give]
        hubs, n = np.unique(root[give], return_counts=True)
        top = np.argsort(-n)[:TOP]
        top = top[n[top] >= max(2, give.sum() / 1024)]
        a = pa.array(np.concatenate((nodes[give], hubs[top])), pa.int64(), mask=np.arange(give.sum() + len(top)) >= give.sum())
        b, n = np.concatenate((root[give], hubs[top])), np.concatenate((np.zeros(give.sum(), np.int64), n[top]))
        return pa.RecordBatch.from_arrays([a, pa.array(b), pa.array(np.concatenate((changed, np.zeros(len(top), bool)))), pa.array(n)], ["a", "b", "moved", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([batch.column(c).to_numpy() for c in ("key", "a", "b")]))
        if sum(h.shape[1] for h in held) >= BLOCK:
            rows = np.concatenate(held, 1)
            last = rows[0] == rows[0, -1]  # a key's edges stay together
            if not last.all():
                yield done(rows[:, ~last])
            held = [rows[:, last]]
    if held:
        yield done(np.concatenate(held, 1))


def _dealt(edges: DataFrame, width: int, hubs: dict[int, int] | None, total: int) -> DataFrame:
    """Each edge for its larger end and, given the hubs (node -> tasks), for its smaller end, in
    partitions sorted by key. Few rows go to few tasks, which join more of them at once."""
    one, a, b = F.lit(0).alias("part"), F.col("a").alias("key"), F.col("b").alias("key")
    if not hubs:
        dealt = edges.select(a, one, "a", "b")
        if hubs is not None:
            dealt = dealt.unionByName(edges.select(b, one, "a", "b"))
    else:
        table = F.broadcast(edges.sparkSession.createDataFrame(list(hubs.items()), "key long, parts int"))
        larger = edges.withColumn("key", F.col("a")).join(table, "key", "left")
        smaller = edges.withColumn("key", F.col("b")).join(table, "key", "left")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        own = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("a"), "parts").cast("int")).otherwise(0).alias("part")
        dealt = larger.select("key", copies, "a", "b").unionByName(smaller.select("key", own, "a", "b"))
    tasks = min(width, max(8, 2 * total // ROWS))
    return dealt.repartition(width, "key", "part").coalesce(tasks).sortWithinPartitions("key", "part").select("key", "a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that an edge (a, b) names, with the smallest node it reaches.
    Self loops name a node; nulls are ignored; no edges give no rows."""
    width = shuffle_width(edges.sparkSession)
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    stars, hubs, more = edges.where("a <> b"), None, True
    total = stars.count()
    while more:
        seen = Observation()
        found = _dealt(stars, width, hubs, total).mapInArrow(_contract, _STARS)
        found = stage(found.observe(seen, F.count("a").alias("n"), F.max("moved").alias("moved")), "stars")
        stars, more = found.where("a IS NOT NULL").select("a", "b"), hubs is None or bool(seen.get["moved"])
        total = seen.get["n"]
        share, hubs = max(2, total // (8 * width)), {}
        for r in found.where("a IS NULL").select("b", "n").collect():  # TOP rows for each block of a task at most
            hubs[r["b"]] = hubs.get(r["b"], 0) + r["n"]
        hubs = {b: -(-n // share) for b, n in hubs.items() if n > share}
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
    least = edges.select(F.col("b").alias("node")).distinct().join(roots, "node", "left_anti")  # has no smaller neighbour
    return roots.unionByName(least.select("node", F.col("node").alias("root")))
