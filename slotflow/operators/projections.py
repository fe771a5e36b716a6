"""Projections and filters (P1-P21). Every function is DataFrame -> DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from slotflow import schemas
from slotflow.functions.columns import all_not_null, column_type, compute_once, safe_col
from slotflow.functions.nested import (
    DEFAULT_CHANNEL,
    TRACKED_EVENT,
    decode_base64_text,
    first_member_field,
    parse_json,
    phone_answer,
)
from slotflow.functions.text import safe_event_id
from slotflow.functions.timeparts import (
    day_name,
    day_of,
    hour_of,
    month_of,
    now,
    parse_timestamp,
    to_day,
    today,
    year_of,
)

S, TS, D, DBL, B = T.StringType(), T.TimestampType(), T.DateType(), T.DoubleType(), T.BooleanType()

# (name, type) of the projected booking columns (P2); timestamps are parsed, never left as text.
BOOKING_PROJECTION: list[tuple[str, T.DataType]] = [
    ("webhook_event", S),
    ("webhook_received_at", TS),
    ("marketing_channel", S),
    ("event_type_url", S),
    ("invitee_uri", S),
    ("invitee_email", S),
    ("invitee_name", S),
    ("invitee_status", S),
    ("invitee_timezone", S),
    ("invitee_phone", S),
    ("invitee_created_at", TS),
    ("invitee_updated_at", TS),
    ("scheduled_event_name", S),
    ("scheduled_event_status", S),
    ("scheduled_event_start_time", TS),
    ("scheduled_event_end_time", TS),
    ("utm_campaign", S),
    ("utm_source", S),
    ("utm_medium", S),
    ("utm_content", S),
    ("utm_term", S),
    ("host_email", S),
    ("host_name", S),
    ("invitee_canceled", B),
]


def _typed(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    current = column_type(df, name)
    if dtype == TS and current is not None and current == S:
        return parse_timestamp(F.col(name)).alias(name)
    return safe_col(df, name, dtype).alias(name)


# Flat bronze field <- field of the nested variant (path under ``payload.payload``).
NESTED_BOOKING_FIELDS = {
    "invitee_uri": "uri",
    "invitee_email": "email",
    "invitee_name": "name",
    "invitee_status": "status",
    "invitee_timezone": "timezone",
    "invitee_created_at": "created_at",
    "invitee_updated_at": "updated_at",
    "invitee_canceled": "canceled",
    "scheduled_event_name": "scheduled_event.name",
    "scheduled_event_status": "scheduled_event.status",
    "scheduled_event_start_time": "scheduled_event.start_time",
    "scheduled_event_end_time": "scheduled_event.end_time",
    "event_type_url": "scheduled_event.event_type",
    "utm_source": "tracking.utm_source",
    "utm_medium": "tracking.utm_medium",
    "utm_campaign": "tracking.utm_campaign",
    "utm_content": "tracking.utm_content",
    "utm_term": "tracking.utm_term",
}


def unify_booking_shapes(df: DataFrame) -> DataFrame:
    """Q11: a bronze frame may hold flat records and nested documents (the webhook kept under
    ``payload.payload``). Each flat field is taken from the record, else from its nested
    counterpart; the phone answer and the first host come from the nested arrays. Frames
    without the nested column pass through unchanged."""
    if column_type(df, "payload.payload") is None:
        return df
    inner = "payload.payload"
    fills = {}
    for flat, nested in NESTED_BOOKING_FIELDS.items():
        path = f"{inner}.{nested}"
        # the nested value, conformed to the flat column's type (or kept as it is)
        from_nested = safe_col(df, path, column_type(df, flat) or column_type(df, path) or S)
        fills[flat] = F.coalesce(F.col(flat), from_nested) if flat in df.columns else from_nested
    qa = safe_col(df, f"{inner}.questions_and_answers", T.ArrayType(schemas.QA))
    members = safe_col(df, f"{inner}.scheduled_event.event_memberships", T.ArrayType(schemas.MEMBERSHIP))
    fills["invitee_phone"] = F.coalesce(safe_col(df, "invitee_phone"), phone_answer(qa))
    fills["host_email"] = F.coalesce(safe_col(df, "host_email"), first_member_field(members, "user_email"))
    fills["host_name"] = F.coalesce(safe_col(df, "host_name"), first_member_field(members, "user_name"))
    fills["webhook_event"] = F.coalesce(safe_col(df, "webhook_event"), safe_col(df, "payload.event"))
    return df.withColumns(fills)


def project_bookings(df: DataFrame) -> DataFrame:
    """Conform any booking frame (flat bronze, partial, typed) to the booking projection."""
    return df.select(*[_typed(df, n, t) for n, t in BOOKING_PROJECTION])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Non [A-Za-z0-9_] -> '_', runs of '_' collapsed, lower case."""
    names = [re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9_]", "_", c)).lower() for c in df.columns]
    return df.toDF(*names)


def flatten_records(df: DataFrame, column: str = "records") -> DataFrame:
    """One row per element of the ``records`` array, struct fields as columns.
    A frame without that column is already flat and passes through."""
    if column not in df.columns:
        return df
    return df.select(F.explode(column).alias("_r")).select("_r.*")


def ensure_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """P5: add each column only when it is missing."""
    missing = {k: v for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def project_spend(df: DataFrame) -> DataFrame:
    """Typed spend projection; unparsable values become null (then P8 drops them)."""
    return df.select(
        safe_col(df, "date", D).alias("date"),
        safe_col(df, "channel", S).alias("channel"),
        safe_col(df, "spend", DBL).alias("spend"),
        _typed(df, "ingested_at", TS),
        safe_col(df, "source_file", S).alias("source_file"),
        safe_col(df, "ingestion_date", D).alias("ingestion_date"),
    )


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with a null business key."""
    return df.filter(all_not_null(keys))


def valid_spend(df: DataFrame) -> DataFrame:
    """Date, channel and spend present, spend >= 0."""
    return df.filter(
        F.col("date").isNotNull()
        & F.col("channel").isNotNull()
        & F.col("spend").isNotNull()
        & (F.col("spend") >= 0)
    )


def filter_event(df: DataFrame, name: str = TRACKED_EVENT, column: str = "event") -> DataFrame:
    """Keep one webhook event kind."""
    return df.filter(F.col(column) == F.lit(name))


def default_channel(df: DataFrame, column: str = "marketing_channel") -> DataFrame:
    """Missing channel -> 'direct'."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(DEFAULT_CHANNEL)))


def unwrap_body(df: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """A request holds the webhook as JSON text in ``body``, as an object in ``body``, or is
    the webhook itself (its fields at the top). Output: event,
    created_at, payload, plus ``raw`` (the body text kept for the audit archive)."""
    if "body" in df.columns:
        if not isinstance(df.schema["body"].dataType, T.StringType):  # an object: its text says the same
            df = df.withColumn("body", F.to_json("body"))
        df = compute_once(df, "_parsed", parse_json(F.col("body"), schemas.WEBHOOK))
    else:
        df = df.withColumn("_parsed", F.lit(None).cast(schemas.WEBHOOK))
    parsed = F.col("_parsed")
    if "body" in df.columns and not any(c in df.columns for c in ("event", "created_at", "payload")):
        # Only the text shape can occur: the parsed body is the webhook.
        return df.select(*keep, "_parsed.event", "_parsed.created_at", "_parsed.payload", F.col("body").alias("raw"))
    direct = F.struct(
        safe_col(df, "event").alias("event"),
        safe_col(df, "created_at").alias("created_at"),
        safe_col(df, "payload", schemas.INVITEE_PAYLOAD).alias("payload"),
    )
    from_text = F.when(parsed["event"].isNotNull() | parsed["payload"].isNotNull(), parsed)
    body = F.coalesce(from_text, direct)
    raw = F.col("body") if "body" in df.columns else F.lit(None).cast("string")
    return df.select(*keep, body.alias("_b"), raw.alias("raw")).select(
        *keep, "_b.event", "_b.created_at", "_b.payload", "raw"
    )


def tag_decode_errors(df: DataFrame, data_col: str = "data") -> DataFrame:
    """P15 without the split: every row gets ``_msg`` (the parsed message) and ``error``
    (null when the row decoded)."""
    tagged = compute_once(df, "_text", decode_base64_text(F.col(data_col)))
    tagged = compute_once(tagged, "_msg", parse_json(F.col("_text"), schemas.ENRICHED))
    error = (
        F.when(F.col(data_col).isNull(), F.lit("missing data"))
        .when(F.col("_text").isNull(), F.lit("invalid base64"))
        .when(F.col("_msg").isNull() | F.col("_msg._corrupt_record").isNotNull(), F.lit("invalid json"))
    )
    return tagged.withColumn("error", error).drop("_text")


def decode_payload(df: DataFrame, data_col: str = "data") -> tuple[DataFrame, DataFrame]:
    """base64 JSON -> enriched message. Returns (good, bad): a row is bad when the
    base64 is invalid or the JSON does not parse; bad rows keep their envelope and an error,
    so a poison row never fails the batch (T3)."""
    tagged = tag_decode_errors(df, data_col)
    good = tagged.filter(F.col("error").isNull()).drop("error")
    bad = tagged.filter(F.col("error").isNotNull()).drop("_msg")
    return good, bad


def enrich_webhook(
    df: DataFrame, channel_col: str = "marketing_channel", keep: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Build the enriched message (three sub-structs + received-at) from an unwrapped
    webhook that already carries its channel."""
    p = F.col("payload")
    se = p["scheduled_event"]
    return df.select(
        *keep,
        F.col("event").alias("webhook_event"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("webhook_received_at"),
        F.col("created_at"),
        F.col(channel_col).alias("marketing_channel"),
        se["event_type"].alias("event_type_url"),
        F.struct(
            p["uri"].alias("uri"),
            p["email"].alias("email"),
            p["name"].alias("name"),
            p["first_name"].alias("first_name"),
            p["last_name"].alias("last_name"),
            p["created_at"].alias("created_at"),
            p["status"].alias("status"),
            p["timezone"].alias("timezone"),
            F.coalesce(p["questions_and_answers"], F.array().cast(T.ArrayType(schemas.QA))).alias("questions_and_answers"),
        ).alias("invitee_data"),
        F.struct(
            se["uri"].alias("uri"),
            se["name"].alias("name"),
            se["start_time"].alias("start_time"),
            se["end_time"].alias("end_time"),
            se["created_at"].alias("created_at"),
            se["status"].alias("status"),
            se["location"].alias("location"),
            F.coalesce(se["event_memberships"], F.array().cast(T.ArrayType(schemas.MEMBERSHIP))).alias("event_memberships"),
        ).alias("scheduled_event_data"),
        p["tracking"].alias("tracking_data"),
    )


def flatten_booking(df: DataFrame, msg_col: str = "_msg", clock: bool = True) -> DataFrame:
    """Enriched message + its envelope -> the flat bronze booking record.

    Date parts come from the event start time; a missing or malformed start time gives null
    parts (never the processing clock, decision Q12)."""
    m = F.col(msg_col)
    inv, se, tr = m["invitee_data"], m["scheduled_event_data"], m["tracking_data"]
    start_text = se["start_time"]
    df = compute_once(df, "_start", parse_timestamp(start_text))
    start = F.col("_start")
    return df.select(
        safe_event_id(F.col("sequence_number")).alias("event_id"),
        F.col("sequence_number").alias("kinesis_sequence_number"),
        F.col("partition_key").alias("kinesis_partition_key"),
        F.col("arrival_ts").alias("kinesis_arrival_timestamp"),
        *([F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at")] if clock else []),
        m["webhook_event"].alias("webhook_event"),
        m["webhook_received_at"].alias("webhook_received_at"),
        m["created_at"].alias("webhook_created_at"),
        F.coalesce(m["marketing_channel"], F.lit(DEFAULT_CHANNEL)).alias("marketing_channel"),
        m["event_type_url"].alias("event_type_url"),
        inv["uri"].alias("invitee_uri"),
        inv["email"].alias("invitee_email"),
        inv["name"].alias("invitee_name"),
        inv["first_name"].alias("invitee_first_name"),
        inv["last_name"].alias("invitee_last_name"),
        inv["created_at"].alias("invitee_created_at"),
        inv["status"].alias("invitee_status"),
        inv["timezone"].alias("invitee_timezone"),
        phone_answer(inv["questions_and_answers"]).alias("invitee_phone"),
        se["uri"].alias("scheduled_event_uri"),
        se["name"].alias("scheduled_event_name"),
        start_text.alias("scheduled_event_start_time"),
        se["end_time"].alias("scheduled_event_end_time"),
        se["created_at"].alias("scheduled_event_created_at"),
        se["status"].alias("scheduled_event_status"),
        se["location"]["type"].alias("scheduled_event_location_type"),
        se["location"]["location"].alias("scheduled_event_location"),
        first_member_field(se["event_memberships"], "user_email").alias("host_email"),
        first_member_field(se["event_memberships"], "user_name").alias("host_name"),
        tr["utm_source"].alias("utm_source"),
        tr["utm_medium"].alias("utm_medium"),
        tr["utm_campaign"].alias("utm_campaign"),
        tr["utm_content"].alias("utm_content"),
        tr["utm_term"].alias("utm_term"),
        F.date_format(start, "yyyy-MM-dd").alias("booking_date"),
        year_of(start).alias("booking_year"),
        month_of(start).alias("booking_month"),
        day_of(start).alias("booking_day"),
        hour_of(start).alias("booking_hour"),
        day_name(start).alias("booking_day_of_week"),
    )


def with_metric_metadata(df: DataFrame, name: str, clock: bool = True) -> DataFrame:
    """``metric_name`` literal and (when ``clock``) ``calculated_at``."""
    df = df.withColumn("metric_name", F.lit(name))
    return df.withColumn("calculated_at", now()) if clock else df


def with_ingest_metadata(df: DataFrame, source_file: Column | None = None) -> DataFrame:
    """ingested_at, source_file (from the scan's file metadata unless given), ingestion_date."""
    src = source_file if source_file is not None else F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.withColumns(
        {
            "ingested_at": now(),
            "source_file": src,
            "ingestion_date": today(),
        }
    )


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """P20: text columns to numbers / dates; unparsable values become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def last_n_days(
    df: DataFrame,
    date_col: str,
    n: int | None,
    as_of: str,
    year_col: str | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """Rows with ``as_of - n < date <= as_of``; ``n`` None keeps all time.

    The bounds are literals. When the table is partitioned by year and month (silver:
    ``booking_year``/``booking_month``; detected by name when not given), an equivalent
    predicate on those columns is added, so the scan reads only the partitions of the
    covered months."""
    if n is None:
        return df
    end = F.lit(as_of).cast("date")
    out = df.filter((F.col(date_col) > F.date_sub(end, n)) & (F.col(date_col) <= end))
    year_col = year_col or next((c for c in ("booking_year", "year") if c in df.columns), None)
    month_col = month_col or next((c for c in ("booking_month", "month") if c in df.columns), None)
    if year_col and month_col:
        import datetime as _dt

        last = _dt.date.fromisoformat(as_of)
        first = last - _dt.timedelta(days=n - 1)
        ym = F.col(year_col) * F.lit(100) + F.col(month_col)
        out = out.filter(ym.between(first.year * 100 + first.month, last.year * 100 + last.month))
    return out


def booking_date_parts(df: DataFrame, start_col: str = "scheduled_event_start_time") -> DataFrame:
    """F3/F4/F5/F6/F8 on a booking frame (year and month as integers, decision Q2)."""
    start = F.col(start_col)
    return df.withColumns(
        {
            "booking_date": to_day(start),
            "booking_year": year_of(start),
            "booking_month": month_of(start),
            "booking_day_of_week": F.dayofweek(start),
            "booking_hour": hour_of(start),
        }
    )
