"""Hand-written edge rows (FIXTURES.md, last section) through the operators."""

import datetime as dt

from pyspark.sql import functions as F

from slotflow.functions.text import first_name, last_name
from slotflow.operators import aggregations as A
from slotflow.operators.upsert import merge_upsert
from slotflow.operators.windows import latest_first, rank_channels
from slotflow.plans import metrics as M
from slotflow.plans.normalize import clean_bookings, clean_spend

D = dt.date


def _bookings(spark):
    rows = [
        ("u1", "a@x", "fb", "2024-01-01T10:00:00Z", "active", "Ann Lee"),
        ("u2", "a@x", "fb", "2024-01-01T11:00:00Z", "canceled", "Bob"),
        (None, "c@x", "fb", "2024-01-01T12:00:00Z", "active", "No Key"),
        ("u4", "d@x", None, "2024-01-02T09:30:00Z", "active", None),
        ("u5", "e@x", "yt", "not-a-time", "active", "  Spaced  Name"),
    ]
    df = spark.createDataFrame(
        rows, "invitee_uri string, invitee_email string, marketing_channel string, scheduled_event_start_time string, invitee_status string, invitee_name string"
    )
    return clean_bookings(df.withColumn("scheduled_event_status", F.col("invitee_status")))


def test_clean_bookings_edges(spark):
    s = {r["invitee_uri"]: r for r in _bookings(spark).collect()}
    assert None not in s  # null key dropped (P7)
    assert s["u1"]["booking_date"] == D(2024, 1, 1) and s["u1"]["booking_hour"] == 10
    assert s["u1"]["booking_day_of_week"] == 2  # Monday, 1 = Sunday
    assert s["u1"]["invitee_first_name"] == "Ann" and s["u1"]["invitee_last_name"] == "Lee"
    assert s["u2"]["invitee_first_name"] == "Bob" and s["u2"]["invitee_last_name"] == ""  # single token
    assert s["u2"]["invitee_canceled"] is True and s["u1"]["invitee_canceled"] is False
    assert s["u4"]["invitee_first_name"] is None  # null name stays null
    assert s["u5"]["booking_date"] is None and s["u5"]["booking_year"] is None  # malformed -> null, never "now"
    assert s["u5"]["invitee_first_name"] == ""  # leading space: no match at start
    # columns absent from the input are typed nulls
    assert s["u1"]["utm_source"] is None and s["u1"]["host_email"] is None


def test_daily_metric_counts(spark):
    out = {(r["booking_date"], r["source"]): r for r in M.daily_bookings_by_source(_bookings(spark), clock=False).collect()}
    fb = out[(D(2024, 1, 1), "fb")]
    assert (fb["total_bookings"], fb["unique_emails"], fb["active_bookings"], fb["cancelled_bookings"]) == (2, 1, 1, 1)
    assert fb["cancellation_rate"] == 50.0
    assert (D(2024, 1, 2), None) in out  # null channel kept as its own group


def _spend(spark):
    rows = [
        ("2024-01-01", "fb", 10.0, "2024-01-02T00:00:00Z", "a.json"),
        ("2024-01-01", "fb", 12.0, "2024-01-03T00:00:00Z", "b.json"),  # later version wins
        ("2024-01-02", "fb", -1.0, "2024-01-03T00:00:00Z", "c.json"),  # negative: dropped
        ("2024-01-02", "yt", None, "2024-01-03T00:00:00Z", "d.json"),  # null: dropped
        ("2024-01-03", "tt", 5.0, "2024-01-04T00:00:00Z", "e.json"),  # spend without bookings
        ("2024-01-03", "tt", 7.0, "2024-01-04T00:00:00Z", "f.json"),  # equal ingested_at: tie-break by spend
        (None, "fb", 1.0, "2024-01-04T00:00:00Z", "g.json"),
    ]
    df = spark.createDataFrame(rows, "date string, channel string, spend double, ingested_at string, source_file string")
    return clean_spend(df, clock=False)


def test_clean_spend_edges(spark):
    s = {(r["date"], r["channel"]): r for r in _spend(spark).collect()}
    assert set(s) == {(D(2024, 1, 1), "fb"), (D(2024, 1, 3), "tt")}
    assert s[(D(2024, 1, 1), "fb")]["spend"] == 12.0
    assert s[(D(2024, 1, 3), "tt")]["spend"] == 7.0
    assert s[(D(2024, 1, 1), "fb")]["year"] == 2024 and s[(D(2024, 1, 1), "fb")]["ingestion_date"] is not None


def test_cost_per_booking_outer_join(spark):
    cpb = M.cost_per_booking(_bookings(spark), _spend(spark), clock=False)
    r = {(x["date"], x["channel"]): x for x in cpb.collect()}
    assert r[(D(2024, 1, 3), "tt")]["total_bookings"] == 0 and r[(D(2024, 1, 3), "tt")]["cost_per_booking"] is None
    assert r[(D(2024, 1, 1), "fb")]["cost_per_booking"] == 6.0
    assert r[(D(2024, 1, 2), None)]["total_spend"] == 0.0  # booking without spend


def test_rank_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", 5, 1.0), ("a", 5, 1.0), ("c", 1, None)], "channel string, total_bookings long, cost_per_booking double")
    r = {x["channel"]: x for x in rank_channels(df).collect()}
    assert (r["a"]["rank_by_bookings"], r["b"]["rank_by_bookings"], r["c"]["rank_by_bookings"]) == (1, 2, 3)
    assert (r["a"]["rank_by_cpb"], r["b"]["rank_by_cpb"], r["c"]["rank_by_cpb"]) == (1, 2, 3)


def test_merge_upsert_replaces_and_evolves(spark):
    tgt = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    src = spark.createDataFrame([("k2", 20, "x"), ("k2", 21, "y"), ("k3", 30, "z"), (None, 0, "n")], "k string, v int, extra string")
    out = {r["k"]: r for r in merge_upsert(tgt, src, ["k"], latest_first("v", ["extra"])).collect()}
    assert set(out) == {"k1", "k2", "k3"}
    assert out["k2"]["v"] == 21 and out["k2"]["extra"] == "y"
    assert out["k1"]["extra"] is None


def test_names(spark):
    df = spark.createDataFrame([("Ann Marie Lee",), ("Solo",), ("",), (None,)], "n string")
    got = [(r[0], r[1]) for r in df.select(first_name(F.col("n")), last_name(F.col("n"))).collect()]
    assert got == [("Ann", "Lee"), ("Solo", ""), ("", ""), (None, None)]


def test_heatmap_fills_zero(spark):
    t = spark.createDataFrame([(9, 2, "fb", 3), (9, 1, "yt", 1), (10, 4, "fb", 2)], "booking_hour int, booking_day_of_week int, marketing_channel string, bookings_count long")
    h = {r["booking_hour"]: r for r in A.booking_heatmap(t).collect()}
    assert h[9]["Monday"] == 3 and h[9]["Sunday"] == 1 and h[9]["Tuesday"] == 0 and h[10]["Wednesday"] == 2


def test_flatten_defaults_channel_and_safe_id(spark):
    """A message without a channel gets 'direct'; the event id is
    the sequence number with ':' -> '-'; an empty membership list gives null hosts; a bad
    base64 payload is isolated."""
    import base64
    import json

    from slotflow.plans.webhooks import decode_to_bronze

    msg = {"webhook_event": "invitee.created", "invitee_data": {"uri": "u1", "questions_and_answers": [
        {"question": "Your PHONE?", "answer": None}, {"question": "phone again", "answer": "2"}]},
        "scheduled_event_data": {"start_time": "2024-03-01T08:15:00Z", "event_memberships": []}}
    rows = [(base64.b64encode(json.dumps(msg).encode()).decode(), "49:1:2", "k", 1.0), ("***", "49:9", "k", 2.0)]
    env = spark.createDataFrame(rows, "data string, sequence_number string, partition_key string, arrival_ts double")
    good, bad = decode_to_bronze(env, clock=False)
    r = good.collect()
    assert len(r) == 1 and r[0]["marketing_channel"] == "direct" and r[0]["event_id"] == "event-49-1-2"
    assert r[0]["invitee_phone"] == ""  # first phone question, its answer missing
    assert r[0]["host_email"] is None and r[0]["booking_hour"] == 8 and r[0]["booking_day_of_week"] == "Friday"
    assert [x["error"] for x in bad.collect()] == ["invalid base64"]


def test_nest_spend_keeps_null_keys_and_every_column(spark):
    """Rows with a null date or channel are kept, with all columns; a document never holds
    rows of two files."""
    rows = [(None, "fb", 1.0, "a", "x"), ("2024-01-01", None, 2.0, "a", "y")] + [("2024-01-02", "hot", 1.0, f"f{i % 4}", "same") for i in range(1000)]
    s = spark.createDataFrame(rows, "date string, channel string, spend double, source_file string, extra string")
    docs = A.nest_spend(s).collect()
    assert sum(d["record_count"] for d in docs) == len(rows) == sum(len(d["records"]) for d in docs)
    assert sorted(d["record_count"] for d in docs if d["channel"] == "hot") == [250] * 4
    assert any(d["date"] is None for d in docs) and any(d["channel"] is None for d in docs)
    assert {r["extra"] for d in docs for r in d["records"]} == {"x", "y", "same"}


def test_default_channel_sort_and_sql(spark):
    """P13 default channel, O1 recent-first sort, S22 SQL over a registered gold view."""
    from slotflow.operators.ordering import sort_recent_first
    from slotflow.operators.projections import default_channel
    from slotflow.plans.readmodels import register_gold_views, run_sql

    df = spark.createDataFrame([(D(2024, 1, 1), None, 1), (D(2024, 1, 2), "fb", 2), (D(2024, 1, 2), "ad", 3)],
                               "date date, marketing_channel string, n int")
    fixed = default_channel(df)
    assert sorted(r["marketing_channel"] for r in fixed.collect()) == ["ad", "direct", "fb"]
    ordered = [(r["date"].day, r["marketing_channel"]) for r in sort_recent_first(fixed, "date", "marketing_channel").collect()]
    assert ordered == [(2, "ad"), (2, "fb"), (1, "direct")]
    register_gold_views({"slotflow_edge_view": fixed})
    assert run_sql(spark, "SELECT sum(n) AS s FROM slotflow_edge_view WHERE marketing_channel <> 'direct'").first()["s"] == 5


def test_ensure_parallelism_only_spreads_narrow_inputs(spark):
    from slotflow.operators.ordering import ensure_parallelism

    cores = spark.sparkContext.defaultParallelism
    narrow = spark.range(100).coalesce(1)
    wide = spark.range(0, 100, 1, cores * 2)
    assert ensure_parallelism(narrow).rdd.getNumPartitions() == cores
    assert ensure_parallelism(wide) is wide
    assert sorted(r[0] for r in ensure_parallelism(narrow).collect()) == list(range(100))
