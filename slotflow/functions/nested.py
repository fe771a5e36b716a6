"""Nested-data helpers (F18-F22, F24): arrays of structs, JSON, base64, map lookups."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed values (must equal the reference's):
#   a phone question is one whose text contains "phone" (case-insensitive);
#   only "invitee.created" webhooks are tracked; a message without a channel gets "direct".
PHONE_QUESTION_MARKER = "phone"
TRACKED_EVENT = "invitee.created"
DEFAULT_CHANNEL = "direct"


def phone_answer(questions_and_answers: Column) -> Column:
    """answer of the first Q&A whose question mentions 'phone' (any case); '' when that
    answer is missing; null when no question matches."""
    matches = F.filter(
        questions_and_answers,
        lambda qa: F.coalesce(F.lower(qa["question"]).contains(PHONE_QUESTION_MARKER), F.lit(False)),
    )
    return F.get(F.transform(matches, lambda qa: F.coalesce(qa["answer"], F.lit(""))), 0)


def first_member_field(memberships: Column, field: str) -> Column:
    """``field`` of the first membership; null for a null or empty array."""
    return F.get(memberships, 0)[field]


def parse_json(text: Column, schema: T.StructType) -> Column:
    """permissive JSON parse; malformed text gives null fields (and ``_corrupt_record``
    when the schema has it)."""
    options = {"mode": "PERMISSIVE"}
    if "_corrupt_record" in schema.fieldNames():
        options["columnNameOfCorruptRecord"] = "_corrupt_record"
    return F.from_json(text, schema, options)



def decode_base64_text(data: Column) -> Column:
    """base64 text to UTF-8 text; invalid base64 gives null instead of failing the job."""
    return F.try_to_binary(data, F.lit("base64")).cast("string")


def encode_base64_text(text: Column) -> Column:
    return F.base64(text.cast("binary"))


def channel_map(event_type_channels: dict[str, str]) -> Column:
    """an event-type URL -> channel map as a literal map column. The map is part of the
    deployment's configuration (``PipelineConfig.event_type_channels``)."""
    args: list[Column] = []
    for url, channel in sorted(event_type_channels.items()):
        args += [F.lit(url), F.lit(channel)]
    return F.create_map(*args)


def lookup_channel(event_type_url: Column, event_type_channels: dict[str, str]) -> Column:
    """channel for a tracked URL, null otherwise (``try_element_at`` never raises)."""
    return F.try_element_at(channel_map(event_type_channels), event_type_url)
