"""Bronze -> silver normalizers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.functions.text import first_name, last_name
from slotflow.operators.projections import (
    booking_date_parts,
    ensure_columns,
    flatten_records,
    project_bookings,
    project_spend,
    require_keys,
    sanitize_columns,
    unify_booking_shapes,
    valid_spend,
)
from slotflow.operators.windows import dedup_latest, latest_first
from slotflow.schemas import SILVER_BOOKING_COLUMNS, SILVER_SPEND_COLUMNS

SPEND_KEYS = ["date", "channel"]
SPEND_TIE_BREAKS = ["spend", "source_file", "ingestion_date"]


def clean_bookings(df: DataFrame) -> DataFrame:
    """Bronze booking records (flat JSON rows, nested webhook documents (Q11), or any frame
    with a subset of the columns) -> silver bookings.

    P2 projection with parsed timestamps, P3 names, first/last name (F1/F2), date parts (F3-F8,
    integer year/month), ``event_status`` (= scheduled event status) and ``invitee_canceled``
    (payload flag when present, else invitee status 'canceled'), rows without ``invitee_uri``
    dropped (P7)."""
    p = sanitize_columns(project_bookings(unify_booking_shapes(df)))
    p = p.withColumns(
        {
            "invitee_first_name": first_name(F.col("invitee_name")),
            "invitee_last_name": last_name(F.col("invitee_name")),
            "event_status": F.col("scheduled_event_status"),
            "invitee_canceled": F.coalesce(
                F.col("invitee_canceled"), F.lower(F.col("invitee_status")) == F.lit("canceled")
            ),
        }
    )
    p = booking_date_parts(p)
    return require_keys(p, ["invitee_uri"]).select(*SILVER_BOOKING_COLUMNS)


def clean_spend(df: DataFrame, clock: bool = True) -> DataFrame:
    """Bronze spend (bare records or ``{records, metadata}`` documents) -> silver spend.

    P4 flatten, P5 metadata defaults, P6 typed projection, year/month/day, P8 quality filter,
    W9 latest row per (date, channel) by ``ingested_at`` with every other column as tie-break,
    processing timestamp (omitted when ``clock`` is False, for comparisons)."""
    flat = flatten_records(df)
    flat = ensure_columns(
        flat,
        {
            "ingested_at": F.current_timestamp(),
            "source_file": F.lit(None).cast("string"),
            "ingestion_date": F.current_date(),
        },
    )
    typed = project_spend(flat).withColumns(
        {"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}
    )
    # Filter before the window so the predicate runs in the scan stage, below the shuffle.
    kept = dedup_latest(valid_spend(typed), SPEND_KEYS, latest_first("ingested_at", SPEND_TIE_BREAKS))
    if not clock:
        return kept.select(*[c for c in SILVER_SPEND_COLUMNS if c != "silver_processing_timestamp"])
    return kept.withColumn("silver_processing_timestamp", F.current_timestamp()).select(*SILVER_SPEND_COLUMNS)
