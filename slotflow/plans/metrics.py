"""Gold metrics (X4-X9 and the weekly trend A10). Each takes silver DataFrames and returns
the gold table; ``clock=False`` leaves out ``calculated_at`` (for reproducible comparisons)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.columns import fill_zero, safe_divide
from slotflow.operators import aggregations as A
from slotflow.operators.joins import join_channel_totals, join_spend_bookings
from slotflow.operators.projections import with_metric_metadata
from slotflow.operators.windows import cumulative_cpb, rank_channels, rolling_avg, share_of_channel

METRIC_NAMES = {
    "daily_bookings_by_source": "daily_bookings_by_source",
    "cost_per_booking": "cost_per_booking",
    "bookings_trend": "bookings_trend_daily",
    "channel_attribution": "channel_attribution",
    "booking_time_analysis": "booking_time_analysis",
    "employee_meeting_load": "employee_meeting_load",
}


def daily_bookings_by_source(bookings: DataFrame, clock: bool = True) -> DataFrame:
    """X4 (metric 1.1)."""
    m = A.daily_bookings_by_source(bookings)
    d = F.col("booking_date")
    m = m.withColumns(
        {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "day_of_week": F.dayofweek(d)}
    )
    return with_metric_metadata(m, METRIC_NAMES["daily_bookings_by_source"], clock)


def cost_per_booking(bookings: DataFrame, spend: DataFrame, clock: bool = True) -> DataFrame:
    """X5 (metric 1.2): A3 + A4 -> J1 full outer -> zeros -> CPB -> W1-W3 running totals."""
    joined = join_spend_bookings(A.spend_by_date_channel(spend), A.bookings_by_date_channel(bookings))
    joined = fill_zero(joined, ["total_bookings", "total_spend"])
    # Running sums use the exact DECIMAL spend; doubles appear only in the output columns.
    m = cumulative_cpb(joined)
    m = m.withColumn("total_spend", F.col("total_spend").cast("double"))
    m = m.withColumn("cost_per_booking", safe_divide(F.col("total_spend"), F.col("total_bookings")))
    m = m.select(
        "date", "channel", "total_spend", "total_bookings", "cost_per_booking",
        "cumulative_spend", "cumulative_bookings", "cumulative_cpb",
    )
    d = F.col("date")
    m = m.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})
    return with_metric_metadata(m, METRIC_NAMES["cost_per_booking"], clock)


def bookings_trend(bookings: DataFrame, clock: bool = True) -> DataFrame:
    """X6 (metric 1.3): A5 -> 7- and 30-row rolling means (one sort: same window order)."""
    m = rolling_avg(rolling_avg(A.daily_trend(bookings), 7), 30)
    d = F.col("date")
    m = m.withColumns({"week_of_year": F.weekofyear(d), "year": F.year(d)})
    return with_metric_metadata(m, METRIC_NAMES["bookings_trend"], clock)


def channel_attribution(bookings: DataFrame, spend: DataFrame, clock: bool = True) -> DataFrame:
    """X7 (metric 1.4): A6 + A7 -> J2 -> CPB / cost per lead -> W6/W7 ranks."""
    m = join_channel_totals(A.channel_spend(spend), A.channel_bookings(bookings))
    m = m.withColumns(
        {
            "cost_per_booking": safe_divide(F.col("total_spend"), F.col("total_bookings")),
            "cost_per_lead": safe_divide(F.col("total_spend"), F.col("unique_leads")),
        }
    )
    return with_metric_metadata(rank_channels(m), METRIC_NAMES["channel_attribution"], clock)


def booking_time_analysis(bookings: DataFrame, clock: bool = True) -> DataFrame:
    """X8 (metric 1.5): A8 -> W8 share of channel."""
    m = share_of_channel(A.booking_time_slots(bookings))
    return with_metric_metadata(m, METRIC_NAMES["booking_time_analysis"], clock)


def employee_meeting_load(bookings: DataFrame, clock: bool = True) -> DataFrame:
    """X9 (metric 1.6, declared by the reference): A9."""
    return with_metric_metadata(A.employee_meeting_load(bookings), METRIC_NAMES["employee_meeting_load"], clock)


def weekly_bookings_trend(bookings: DataFrame) -> DataFrame:
    """A10: weekly volume by source."""
    return A.weekly_trend(A.daily_trend(bookings))


GOLD_METRICS = {
    "daily_bookings_by_source": lambda b, s, clock=True: daily_bookings_by_source(b, clock),
    "cost_per_booking": lambda b, s, clock=True: cost_per_booking(b, s, clock),
    "bookings_trend": lambda b, s, clock=True: bookings_trend(b, clock),
    "channel_attribution": lambda b, s, clock=True: channel_attribution(b, s, clock),
    "booking_time_analysis": lambda b, s, clock=True: booking_time_analysis(b, clock),
    "employee_meeting_load": lambda b, s, clock=True: employee_meeting_load(b, clock),
}
