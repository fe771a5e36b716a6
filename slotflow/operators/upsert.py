"""Keyed upsert as a DataFrame operation (J4): matched rows are replaced, new rows inserted.

``merge_upsert`` is the pure relational form (target anti-join source, union the deduplicated
source). ``slotflow.sources.tables.upsert_table`` applies it to a partitioned table on disk,
rewriting only the partitions the source touches; it uses ``merge_versions``, which lets the
newest of all versions win, old and new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.functions.columns import all_not_null
from slotflow.operators.windows import dedup_latest


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    allow_missing_columns: bool = True,
) -> DataFrame:
    """J4/S6/S7/S9. ``order`` picks the winner among source rows sharing a key (first wins);
    without it, the source must already be unique on ``keys``. Source rows with a null key
    are dropped (a null never matches, and could never be updated again).

    Additive schema evolution: columns only in the source appear with nulls for old rows,
    columns only in the target stay, with nulls for new rows."""
    src = source.filter(all_not_null(keys))
    # The anti-join needs only the batch's key set, which the dedup does not change: it reads
    # the key columns of the raw batch (duplicates are harmless to an anti-join), so the dedup
    # window runs once, on the union branch.
    keep = target.join(src.select(*keys), on=keys, how="left_anti")
    if order:
        src = dedup_latest(src, keys, order)
    return keep.unionByName(src, allowMissingColumns=allow_missing_columns)


FILTER_SLOTS = 1 << 20


def held_keys(table: DataFrame, source: DataFrame, keys: list[str], n_source: int, slots: int = FILTER_SLOTS) -> DataFrame:
    """Rows of ``table`` whose keys are in ``source``. Keys are hashed to ``slots``; the slots of the
    source's ``n_source`` keys (a broadcast of at most ``slots`` numbers, whatever the batch) pass a
    row of the table right above its scan, so that little of a large table is shuffled to the exact
    join. A batch that fills most slots would hold nothing back and is joined directly."""
    if 2 * n_source <= slots:
        slot = F.pmod(F.xxhash64(*keys), F.lit(slots))
        used = source.select(slot.alias("_slot")).distinct()
        table = table.withColumn("_slot", slot).join(F.broadcast(used), "_slot", "left_semi").drop("_slot")
    return table.join(source.select(*keys), keys, "left_semi")


def merge_versions(old: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """J4 with versions: per key, the first by ``order`` of the old rows and the source's row (of
    ties the source's). Without ``order`` the source's row wins. Old rows of other keys stay. The
    source is unique on ``keys``; columns on one side only are null on the other."""
    if not order:
        return merge_upsert(old, source, keys)
    touched = source.select(*keys)
    stay = old.join(touched, keys, "left_anti")
    mine = source.withColumn("_new", F.lit(1))
    theirs = old.join(touched, keys, "left_semi").withColumn("_new", F.lit(0))
    versions = mine.unionByName(theirs, allowMissingColumns=True)
    newest = dedup_latest(versions, keys, [*order, F.col("_new").desc()]).drop("_new")
    return stay.unionByName(newest, allowMissingColumns=True)
