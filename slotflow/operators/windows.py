"""Window functions.

All windows except the dedup (W9) run on aggregated tables: (date, channel) or channel grain,
whose size is bounded by days x channels, not by the number of bookings. W9 runs on raw rows;
``row_number() == 1`` lets Catalyst insert a partial WindowGroupLimit before the shuffle, so
copies of one key are cut to one per map task before they are exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from slotflow.functions.columns import MONEY_SUM_TYPE, percentage, safe_divide


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def cumulative_cpb(df: DataFrame, partition: str = "channel", order: str = "date") -> DataFrame:
    """Running spend, running bookings and running cost per booking per channel.
    One window spec, so Spark computes the three columns in one Window operator (one sort)."""
    w = (
        Window.partitionBy(partition)
        .orderBy(*_order([order, "total_spend", "total_bookings"]))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    run_spend = F.sum(F.col("total_spend").cast(MONEY_SUM_TYPE)).over(w).cast("double")
    run_book = F.sum("total_bookings").over(w)
    return (
        df.withColumn("cumulative_spend", run_spend)
        .withColumn("cumulative_bookings", run_book)
        .withColumn("cumulative_cpb", safe_divide(F.col("cumulative_spend"), F.col("cumulative_bookings")))
    )


def rolling_avg(df: DataFrame, rows: int, value: str = "bookings_count", partition: str = "source", order: str = "date", name: str | None = None) -> DataFrame:
    """Mean over the current row and the ``rows - 1`` rows before it (a row frame:
    a day without bookings is absent, not zero, as in the reference)."""
    w = Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_first()).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name or f"rolling_avg_{rows}d", F.avg(value).over(w))


def rank_channels(df: DataFrame) -> DataFrame:
    """1-based ranks by bookings (desc) and by cost per booking (asc, nulls last),
    ties broken by channel. Runs on the channel-grain table (one row per channel), so the
    unpartitioned window sorts a bounded number of rows."""
    by_bookings = Window.orderBy(F.col("total_bookings").desc_nulls_last(), F.col("channel").asc_nulls_first())
    by_cpb = Window.orderBy(F.col("cost_per_booking").asc_nulls_last(), F.col("channel").asc_nulls_first())
    return df.withColumn("rank_by_bookings", F.row_number().over(by_bookings)).withColumn(
        "rank_by_cpb", F.row_number().over(by_cpb)
    )


def share_of_channel(df: DataFrame, value: str = "bookings_count", partition: str = "marketing_channel") -> DataFrame:
    """Partition total and percentage of it."""
    w = Window.partitionBy(partition)
    return df.withColumn("total_channel_bookings", F.sum(value).over(w)).withColumn(
        "percentage_of_channel", percentage(F.col(value), F.col("total_channel_bookings"))
    )


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (callers add tie-breaks so the winner
    is deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_first(primary: str, rest: list[str]) -> list[Column]:
    """Ordering for W9: ``primary`` descending, then every other column descending, nulls last."""
    return [F.col(primary).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in rest]


def cumulative_bookings(df: DataFrame, value: str = "total_bookings", partition: str = "source", order: str = "date") -> DataFrame:
    """Running total of daily bookings per source."""
    w = (
        Window.partitionBy(partition)
        .orderBy(F.col(order).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("cumulative", F.sum(value).over(w))
