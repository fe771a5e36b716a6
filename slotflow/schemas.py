"""Explicit schemas: nothing in the pipeline relies on JSON schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, D, DBL, L, I, B = (
    T.StringType(),
    T.TimestampType(),
    T.DateType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


QA = _struct(("question", S), ("answer", S))
MEMBERSHIP = _struct(("user_email", S), ("user_name", S), ("user", S))
LOCATION = _struct(("type", S), ("location", S))
TRACKING = _struct(("utm_source", S), ("utm_medium", S), ("utm_campaign", S), ("utm_content", S), ("utm_term", S))
COUNTER = _struct(("active", L), ("limit", L), ("total", L))

SCHEDULED_EVENT = _struct(
    ("uri", S),
    ("name", S),
    ("start_time", S),
    ("end_time", S),
    ("created_at", S),
    ("status", S),
    ("event_type", S),
    ("location", LOCATION),
    ("event_memberships", T.ArrayType(MEMBERSHIP)),
    ("invitees_counter", COUNTER),
)

# Webhook payload (the invitee object with its scheduled event).
INVITEE_PAYLOAD = _struct(
    ("uri", S),
    ("email", S),
    ("name", S),
    ("first_name", S),
    ("last_name", S),
    ("created_at", S),
    ("updated_at", S),
    ("status", S),
    ("timezone", S),
    ("canceled", B),
    ("rescheduled", B),
    ("questions_and_answers", T.ArrayType(QA)),
    ("tracking", TRACKING),
    ("scheduled_event", SCHEDULED_EVENT),
)

# Raw webhook body: {event, created_at, payload}.
WEBHOOK = _struct(("event", S), ("created_at", S), ("payload", INVITEE_PAYLOAD))

# Request envelope: the body arrives as JSON text, as an object, or the request is the body.
REQUEST = _struct(("body", S), ("event", S), ("created_at", S), ("payload", INVITEE_PAYLOAD))

# Enriched message put on the booking stream.
ENRICHED = _struct(
    ("webhook_event", S),
    ("webhook_received_at", S),
    ("created_at", S),
    ("marketing_channel", S),
    ("event_type_url", S),
    (
        "invitee_data",
        _struct(
            ("uri", S),
            ("email", S),
            ("name", S),
            ("first_name", S),
            ("last_name", S),
            ("created_at", S),
            ("status", S),
            ("timezone", S),
            ("questions_and_answers", T.ArrayType(QA)),
        ),
    ),
    (
        "scheduled_event_data",
        _struct(
            ("uri", S),
            ("name", S),
            ("start_time", S),
            ("end_time", S),
            ("created_at", S),
            ("status", S),
            ("location", LOCATION),
            ("event_memberships", T.ArrayType(MEMBERSHIP)),
        ),
    ),
    ("tracking_data", TRACKING),
    ("_corrupt_record", S),
)

# Queue record envelope.
STREAM_RECORD = _struct(
    ("data", S), ("sequence_number", S), ("partition_key", S), ("arrival_ts", DBL)
)

# Flat bronze booking record (one JSON object per file). These field names are
# the bronze layout existing bronze files carry (including the stream-envelope fields).
BRONZE_BOOKING_FIELDS: list[tuple[str, T.DataType]] = [
    ("event_id", S),
    ("kinesis_sequence_number", S),
    ("kinesis_partition_key", S),
    ("kinesis_arrival_timestamp", DBL),
    ("processed_at", S),
    ("webhook_event", S),
    ("webhook_received_at", S),
    ("webhook_created_at", S),
    ("marketing_channel", S),
    ("event_type_url", S),
    ("invitee_uri", S),
    ("invitee_email", S),
    ("invitee_name", S),
    ("invitee_first_name", S),
    ("invitee_last_name", S),
    ("invitee_created_at", S),
    ("invitee_status", S),
    ("invitee_timezone", S),
    ("invitee_phone", S),
    ("scheduled_event_uri", S),
    ("scheduled_event_name", S),
    ("scheduled_event_start_time", S),
    ("scheduled_event_end_time", S),
    ("scheduled_event_created_at", S),
    ("scheduled_event_status", S),
    ("scheduled_event_location_type", S),
    ("scheduled_event_location", S),
    ("host_email", S),
    ("host_name", S),
    ("utm_source", S),
    ("utm_medium", S),
    ("utm_campaign", S),
    ("utm_content", S),
    ("utm_term", S),
    ("booking_date", S),
    ("booking_year", I),
    ("booking_month", I),
    ("booking_day", I),
    ("booking_hour", I),
    ("booking_day_of_week", S),
]
# The nested bronze variant: the webhook kept whole under ``payload`` ({event, time,
# payload: invitee}), next to the top-level channel fields (decision Q11: one normalizer
# accepts both shapes).
NESTED_BOOKING = _struct(("event", S), ("time", S), ("payload", INVITEE_PAYLOAD))
BRONZE_BOOKING = _struct(*BRONZE_BOOKING_FIELDS, ("payload", NESTED_BOOKING))
CORRUPT = "_corrupt_record"

# Spend rows: the source files (bare arrays) and the bronze documents {records, metadata}.
SPEND_RECORD = _struct(
    # Numbers are read as text and cast later: a quoted one must not void its document.
    ("date", S),
    ("channel", S),
    ("spend", S),
    ("impressions", S),
    ("clicks", S),
    ("ingested_at", S),
    ("source_file", S),
    ("ingestion_date", S),
)
SPEND_METADATA = _struct(("ingestion_date", S), ("record_count", L), ("channel", S), ("date", S))
BRONZE_SPEND = T.StructType(
    [
        T.StructField("records", T.ArrayType(SPEND_RECORD), True),
        T.StructField("metadata", SPEND_METADATA, True),
    ]
    + [T.StructField(f.name, f.dataType, True) for f in SPEND_RECORD.fields]
)

# Silver bookings: the 21 projected columns, host columns (needed by the meeting-load
# metric), the derived columns, and the status names gold reads (decision Q1).
SILVER_BOOKING_COLUMNS = [
    "webhook_event",
    "webhook_received_at",
    "marketing_channel",
    "event_type_url",
    "invitee_uri",
    "invitee_email",
    "invitee_name",
    "invitee_status",
    "invitee_timezone",
    "invitee_phone",
    "invitee_created_at",
    "invitee_updated_at",
    "scheduled_event_name",
    "scheduled_event_status",
    "scheduled_event_start_time",
    "scheduled_event_end_time",
    "utm_campaign",
    "utm_source",
    "utm_medium",
    "utm_content",
    "utm_term",
    "host_email",
    "host_name",
    "invitee_first_name",
    "invitee_last_name",
    "event_status",
    "invitee_canceled",
    "booking_date",
    "booking_year",
    "booking_month",
    "booking_day_of_week",
    "booking_hour",
]

SILVER_SPEND_COLUMNS = [
    "date",
    "channel",
    "spend",
    "ingested_at",
    "source_file",
    "ingestion_date",
    "year",
    "month",
    "day",
    "silver_processing_timestamp",
]

RUN_LOG = _struct(
    ("pipeline_id", S),
    ("execution_date", S),
    ("timestamp", TS),
    ("records_processed", L),
    ("files_processed", L),
    ("status", S),
    ("error_message", S),
)
