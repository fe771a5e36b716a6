"""Adapters: booking, spend and webhook inputs derived from the driver's tables.

Each adapter is a projection (plus, for spend and meetings, one equi-join) over a whole table,
so its size grows with the table. The same derivations are written as SQL CTEs in
``slotflow.plans.oracle`` for the DuckDB cross-check.

E: ``events`` -> bookings (channel = event_type) and spend (channel = event_type, but 'display' for
   'view': each side has a channel that the other lacks).
O: ``orders`` -> bookings; ``lineitem`` x ``orders`` -> spend; ``lineitem`` x ``supplier`` -> meetings.
N: ``events`` -> nested webhook documents / stream envelopes (JSON text, base64).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotflow.functions.nested import encode_base64_text
from slotflow.operators.ordering import ROWS_A_SPLIT, ensure_parallelism, number_in_groups, splits_for

# Fixture values of adapter N: the event types on the allow-list and their channels.
FIXTURE_EVENT_TYPE_CHANNELS = {"purchase": "search_ads", "signup": "social_ads", "view": "video_ads"}
PART_RECORDS = 1000  # elements of a spend source file; a day has as many files as it needs
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _canceled(event_id: Column) -> Column:
    return (event_id % 10) == 0


# ---------------------------------------------------------------- adapter E (events)
def events_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped booking rows, one per event."""
    ev = read_table(spark, sf_dir, "events")
    status = F.when(_canceled(F.col("event_id")), F.lit("canceled")).otherwise(F.lit("active"))
    return ev.select(
        F.lit("invitee.created").alias("webhook_event"),
        F.col("ts").alias("webhook_received_at"),
        F.col("event_type").alias("marketing_channel"),
        F.concat(F.lit("inv-"), F.col("event_id").cast("string")).alias("invitee_uri"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("invitee_email"),
        status.alias("invitee_status"),
        status.alias("scheduled_event_status"),
        F.col("ts").alias("scheduled_event_start_time"),
    )


def events_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend records, one per event: date, channel, spend = value, ingested_at = ts."""
    ev = read_table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return ev.select(
        day.alias("date"),
        F.when(F.col("event_type") == "view", "display").otherwise(F.col("event_type")).alias("channel"),
        F.col("value").alias("spend"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("spend_data_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".json")).alias("source_file"),
        day.alias("ingestion_date"),
    )


# ---------------------------------------------------------------- adapter O (orders, lineitem)
def _order_status(c: Column) -> Column:
    return (
        F.when(c == "F", F.lit("completed"))
        .when(c == "O", F.lit("active"))
        .when(c == "P", F.lit("canceled"))
    )


def orders_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped booking rows, one per order (channel = order priority)."""
    o = read_table(spark, sf_dir, "orders")
    status = _order_status(F.col("o_orderstatus"))
    return o.select(
        F.lit("invitee.created").alias("webhook_event"),
        F.col("o_orderpriority").alias("marketing_channel"),
        F.col("o_orderkey").cast("string").alias("invitee_uri"),
        F.col("o_custkey").cast("string").alias("invitee_email"),
        status.alias("invitee_status"),
        status.alias("scheduled_event_status"),
        F.col("o_orderdate").alias("scheduled_event_start_time"),
    )


def lineitem_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend records, one per line item: date = ship date, channel = its order's priority,
    spend = extended price x discount, ingested_at = order date."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_discount")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    day = F.to_date("l_shipdate")
    return j.select(
        day.alias("date"),
        F.col("o_orderpriority").alias("channel"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("spend"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("spend_data_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".json")).alias("source_file"),
        F.to_date("o_orderdate").alias("ingestion_date"),
    )


def lineitem_meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped meeting rows, one per line item, hosted by its supplier."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "inner")
    return j.select(
        F.lit("invitee.created").alias("webhook_event"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("invitee_uri"),
        F.concat(F.col("s_name"), F.lit("@example.com")).alias("host_email"),
        F.col("s_name").alias("host_name"),
        F.col("l_shipdate").alias("scheduled_event_start_time"),
        F.lit("active").alias("scheduled_event_status"),
    )


def spend_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend source files as lines (file, part, value), in order, the lines of a part in one task: for
    each day of the events JSON arrays of at most ``PART_RECORDS`` elements, one per event, with fields
    that no metric reads. The spend of a seventh of the events is quoted, elements of events divisible
    by 97 are bare numbers, and the files of each month's 13th lack their closing bracket. No file is
    ever one value."""
    ev = read_table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    of_day = ev.groupBy(F.col("day").alias("_day")).agg(F.count("*").alias("in_day"))
    lines = number_in_groups(ev, ["day"], ["event_id"], "place").join(of_day, F.col("day").eqNullSafe(F.col("_day")))
    rest = [F.col("day").alias("date"), F.col("event_type").alias("channel"), F.col("user_id").alias("impressions"),
            (F.col("event_id") % 5).alias("clicks"), F.struct("event_type", "props").alias("flags")]
    record = F.when(F.col("event_id") % 7 == 3, F.to_json(F.struct(F.col("value").cast("string").alias("spend"), *rest))).otherwise(
        F.to_json(F.struct(F.col("value").alias("spend"), *rest)))
    element = F.when(F.col("event_id") % 97 == 0, F.col("event_id").cast("string")).otherwise(record)
    at = F.col("place") - 1
    first, last = at % PART_RECORDS == 0, (F.col("place") == F.col("in_day")) | (at % PART_RECORDS == PART_RECORDS - 1)
    end = F.when(last & ~F.col("day").endswith("-13"), "]").otherwise("")
    lines = lines.select(
        F.concat(F.lit("spend_data_"), F.coalesce("day", F.lit("none")), F.lit(".json")).alias("file"), F.floor(at / PART_RECORDS).cast("int").alias("part"),
        at.alias("at"), F.concat(F.when(first, "[").otherwise(","), element, end).alias("value"),
    )
    tasks = splits_for(lines, ev.count(), ROWS_A_SPLIT)
    return lines.repartition(tasks, "file", "part").sortWithinPartitions("file", "part", "at").select("file", "part", "value")


# ---------------------------------------------------------------- adapter N (nested webhooks)
def _iso(c: Column) -> Column:
    return F.date_format(c, ISO_MICROS_Z)


def events_webhooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One webhook body (struct, shape of a real webhook) per event, with ``event_id`` kept.

    event = 'invitee.created' unless event_id % 4 = 0 ('invitee.canceled'); a phone question
    when event_id % 3 = 0; no host when event_id % 5 = 0; malformed start when event_id % 97 = 0."""
    ev = ensure_parallelism(read_table(spark, sf_dir, "events"))
    eid = F.col("event_id")
    start = F.when(eid % 97 == 0, F.lit("not-a-time")).otherwise(_iso(F.col("ts")))
    second_q = F.when(eid % 3 == 0, F.lit("Phone number")).otherwise(F.lit("Role"))
    host_no = (F.col("user_id") % 9).cast("string")
    members = F.when(eid % 5 == 0, F.array()).otherwise(
        F.array(
            F.struct(
                F.concat(F.lit("host"), host_no, F.lit("@example.com")).alias("user_email"),
                F.concat(F.lit("Host "), host_no).alias("user_name"),
            )
        )
    )
    status = F.when(_canceled(eid), F.lit("canceled")).otherwise(F.lit("active"))
    payload = F.struct(
        F.concat(F.lit("inv-"), eid.cast("string")).alias("uri"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
        _iso(F.col("ts")).alias("created_at"),
        status.alias("status"),
        F.lit("UTC").alias("timezone"),
        F.array(
            F.struct(F.lit("Company").alias("question"), F.col("props").alias("answer")),
            F.struct(second_q.alias("question"), F.concat(F.lit("+1-555-"), eid.cast("string")).alias("answer")),
        ).alias("questions_and_answers"),
        F.struct(
            F.col("event_type").alias("utm_source"),
            F.lit("cpc").alias("utm_medium"),
            F.concat(F.lit("camp-"), (F.col("user_id") % 7).cast("string")).alias("utm_campaign"),
        ).alias("tracking"),
        F.struct(
            F.concat(F.lit("se-"), eid.cast("string")).alias("uri"),
            F.lit("Intro call").alias("name"),
            start.alias("start_time"),
            _iso(F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_time"),
            _iso(F.col("ts")).alias("created_at"),
            status.alias("status"),
            F.col("event_type").alias("event_type"),
            F.struct(F.lit("zoom").alias("type"), F.lit("https://example.com/meet").alias("location")).alias("location"),
            members.alias("event_memberships"),
        ).alias("scheduled_event"),
    )
    event = F.when(eid % 4 == 0, F.lit("invitee.canceled")).otherwise(F.lit("invitee.created"))
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return ev.select(
        eid.alias("event_id"),
        arrival.alias("_ts"),
        F.struct(event.alias("event"), _iso(F.col("ts")).alias("created_at"), payload.alias("payload")).alias("webhook"),
    )


def events_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP-style requests: ``body`` holds the webhook as JSON text (P14's main shape)."""
    w = events_webhooks(spark, sf_dir)
    return w.select("event_id", "_ts", F.to_json("webhook").alias("body"))


def enriched_envelopes(enriched: DataFrame) -> DataFrame:
    """Stream envelopes over enriched messages: base64 JSON, sequence number, key, arrival
    time. The JSON is cut short when event_id % 101 = 0 and the base64 is invalid when
    event_id % 211 = 0 (poison rows)."""
    eid = F.col("event_id")
    text = F.to_json(F.struct(*[c for c in enriched.columns if c not in ("event_id", "_ts")]))
    broken = F.when(eid % 101 == 0, F.expr("substring(_text, 1, length(_text) - 2)")).otherwise(F.col("_text"))
    data = F.when(eid % 211 == 0, F.lit("%%not-base64%%")).otherwise(encode_base64_text(broken))
    return enriched.withColumn("_text", text).select(
        eid,
        data.alias("data"),
        F.format_string("shard-0:%020d", eid).alias("sequence_number"),
        F.col("marketing_channel").alias("partition_key"),
        F.col("_ts").alias("arrival_ts"),
    )


def nested_bronze_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested bronze variant (FIXTURES 1.4): every webhook kept whole under ``payload``
    ({event, time, payload}) next to the top-level channel fields (no channel if untracked)."""
    w = events_webhooks(spark, sf_dir)
    url = F.col("webhook.payload.scheduled_event.event_type")
    channels = F.create_map(*[x for k, v in sorted(FIXTURE_EVENT_TYPE_CHANNELS.items()) for x in (F.lit(k), F.lit(v))])
    return w.select(
        F.col("webhook.event").alias("webhook_event"),
        F.col("webhook.created_at").alias("webhook_received_at"),
        F.try_element_at(channels, url).alias("marketing_channel"),
        url.alias("event_type_url"),
        F.struct(
            F.col("webhook.event").alias("event"),
            F.col("webhook.created_at").alias("time"),
            F.col("webhook.payload").alias("payload"),
        ).alias("payload"),
    )
