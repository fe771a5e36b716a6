"""Webhook intake and stream decoding as DataFrame plans. The streaming jobs in
``slotflow.streaming`` run the same functions on each micro-batch, so batch and stream give
the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotflow.operators.joins import attribute_channel
from slotflow.operators.projections import (
    decode_payload,
    enrich_webhook,
    filter_event,
    flatten_booking,
    unwrap_body,
)


def process_webhooks(
    requests: DataFrame, event_type_channels: dict[str, str], keep: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """T1 (stateless): P14 unwrap -> P9 'invitee.created' only -> P10 allow-list + channel ->
    P11 enriched message. ``keep`` columns pass through (for example a request id)."""
    u = filter_event(unwrap_body(requests, keep))
    u = u.withColumn("event_type_url", F.col("payload.scheduled_event.event_type"))
    return enrich_webhook(attribute_channel(u, event_type_channels), keep=keep)


def enriched_to_message(enriched: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Keyed message (key = channel, so one channel's messages stay in order on one
    partition of a keyed stream), value = the enriched JSON."""
    body = [c for c in enriched.columns if c not in keep]
    return enriched.select(
        *keep, F.col("marketing_channel").alias("key"), F.to_json(F.struct(*body)).alias("value")
    )


def decode_to_bronze(envelopes: DataFrame, clock: bool = True) -> tuple[DataFrame, DataFrame]:
    """T2 + T3: decode (P15) and flatten (P12) good rows; bad rows go to the dead-letter
    frame with their error, the batch itself never fails on them."""
    good, bad = decode_payload(envelopes)
    return flatten_booking(good, clock=clock), bad
