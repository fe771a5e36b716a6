"""slotflow: booking and ad-spend analytics on Spark (bronze -> silver -> gold, batch and stream).

The main entry points are re-exported here; every transformation is also available on its
own as a DataFrame -> DataFrame function in ``slotflow.operators`` and ``slotflow.plans``.
"""

__version__ = "0.1.0"

from slotflow.config import PipelineConfig
from slotflow.plans.batch_jobs import bronze_to_silver, bronze_to_silver_incremental, ingest_spend, silver_to_gold
from slotflow.plans.metrics import (
    booking_time_analysis,
    bookings_trend,
    channel_attribution,
    cost_per_booking,
    daily_bookings_by_source,
    employee_meeting_load,
)
from slotflow.plans.normalize import clean_bookings, clean_spend
from slotflow.plans.webhooks import decode_to_bronze, process_webhooks
from slotflow.session import build_session, configure
from slotflow.sources.tables import upsert_table
from slotflow.streaming.jobs import bronze_writer, live_daily_counts, start_bronze_writer, webhook_intake

__all__ = [
    "PipelineConfig",
    "booking_time_analysis",
    "bookings_trend",
    "bronze_to_silver",
    "bronze_to_silver_incremental",
    "bronze_writer",
    "build_session",
    "channel_attribution",
    "clean_bookings",
    "clean_spend",
    "configure",
    "cost_per_booking",
    "daily_bookings_by_source",
    "decode_to_bronze",
    "employee_meeting_load",
    "ingest_spend",
    "live_daily_counts",
    "process_webhooks",
    "silver_to_gold",
    "start_bronze_writer",
    "upsert_table",
    "webhook_intake",
]
