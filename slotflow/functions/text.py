"""String helpers: person names (F1, F2), safe ids (F17), prefix/suffix tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values (must equal the reference's for the same results):
#   first name = first run of non-space characters at the start of the full name
#   last name  = last run of non-space characters after at least one space
#   stream event id = "event-" followed by the sequence number with ":" replaced by "-"
FIRST_NAME_PATTERN = r"^(\S+)"
LAST_NAME_PATTERN = r"\s+(\S+)$"
EVENT_ID_PREFIX = "event-"


def first_name(full_name: Column) -> Column:
    """'' when nothing matches, null for null input."""
    return F.regexp_extract(full_name, FIRST_NAME_PATTERN, 1)


def last_name(full_name: Column) -> Column:
    """'' for a single-token name, null for null input."""
    return F.regexp_extract(full_name, LAST_NAME_PATTERN, 1)


def safe_event_id(sequence_number: Column) -> Column:
    """deterministic record id from a stream sequence number."""
    return F.concat(F.lit(EVENT_ID_PREFIX), F.replace(sequence_number, F.lit(":"), F.lit("-")))


def has_prefix_suffix(c: Column, prefix: str, suffix: str) -> Column:
    """F25."""
    return c.startswith(prefix) & c.endswith(suffix)
