"""Joins (J1-J3, P10).

No join here carries a broadcast hint on a data-sized side: Spark's size check
(``autoBroadcastJoinThreshold`` on plan statistics) and AQE's runtime re-plan decide between
broadcast and sort-merge, so a dimension that grows with the data falls back to a shuffle.
Only the channel map, a literal of a few entries, is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.functions.nested import lookup_channel


def join_spend_bookings(spend_agg: DataFrame, bookings_agg: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Full outer equi-join USING (date, channel); key columns merged. Both inputs are
    aggregates on the same keys, so the join reuses their hash partitioning (two exchanges in
    all). Null keys never match: such rows stay as separate rows."""
    return spend_agg.join(bookings_agg, on=keys or ["date", "channel"], how="full_outer")


def join_channel_totals(spend: DataFrame, bookings: DataFrame) -> DataFrame:
    """Full outer join of per-channel spend (``channel``) and per-channel bookings
    (``marketing_channel``) with an explicit key coalesce; missing measures become 0."""
    joined = spend.join(bookings, spend["channel"] == bookings["marketing_channel"], "full_outer")
    return joined.select(
        F.coalesce(spend["channel"], bookings["marketing_channel"]).alias("channel"),
        F.coalesce(bookings["total_bookings"], F.lit(0).cast("long")).alias("total_bookings"),
        F.coalesce(bookings["unique_leads"], F.lit(0).cast("long")).alias("unique_leads"),
        F.coalesce(spend["total_spend"].cast("double"), F.lit(0.0)).alias("total_spend"),
    )


def channel_dimension(spark: SparkSession, event_type_channels: dict[str, str]) -> DataFrame:
    """The allow-list as a two-column dimension (event_type_url, marketing_channel)."""
    rows = sorted(event_type_channels.items())
    return spark.createDataFrame(rows, "event_type_url string, marketing_channel string")


def attribute_channel(
    df: DataFrame,
    event_type_channels: dict[str, str],
    url_col: str = "event_type_url",
) -> DataFrame:
    """Keep rows whose event-type URL is on the allow-list and add their channel.

    The allow-list is a configuration literal of a few entries, so the lookup is a map
    expression evaluated in the scan stage (the same result as an inner join with a
    broadcast dimension, without an exchange or a join node)."""
    channel = lookup_channel(F.col(url_col), event_type_channels)
    return df.withColumn("marketing_channel", channel).filter(F.col("marketing_channel").isNotNull())


def attribute_channel_join(df: DataFrame, dimension: DataFrame, url_col: str = "event_type_url") -> DataFrame:
    """J3 for a dimension table kept as data (for example a catalog table): inner equi-join.
    Spark broadcasts the dimension when its statistics are under the threshold."""
    dim = dimension.withColumnRenamed("event_type_url", "_dim_url")
    return df.join(dim, df[url_col] == dim["_dim_url"], "inner").drop("_dim_url")
