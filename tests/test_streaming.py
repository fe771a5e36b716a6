"""Streams give the same rows as the batch plans (availableNow on temp folders)."""

import json
import os

from pyspark.sql import functions as F

from slotflow import schemas
from slotflow.plans.webhooks import process_webhooks
from slotflow.sources import adapters as AD
from slotflow.streaming import jobs as J
from conftest import SF_SMALL


def test_webhook_intake_stream_equals_batch(spark, tmp_dir):
    reqs = AD.events_requests(spark, SF_SMALL).select("body")
    reqs.write.text(f"{tmp_dir}/requests")
    qs = J.webhook_intake(spark, f"{tmp_dir}/requests", f"{tmp_dir}/messages", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt",
                          AD.FIXTURE_EVENT_TYPE_CHANNELS, trigger={"availableNow": True})
    J.run_to_end(qs)
    streamed = spark.read.schema("key string, value string").json(f"{tmp_dir}/messages")
    batch = process_webhooks(reqs, AD.FIXTURE_EVENT_TYPE_CHANNELS)
    assert streamed.count() == batch.count() > 0
    uris = streamed.select(F.get_json_object("value", "$.invitee_data.uri").alias("u"))
    assert uris.exceptAll(batch.select(F.col("invitee_data.uri").alias("u"))).count() == 0
    archive = spark.read.json(f"{tmp_dir}/archive")
    assert archive.count() == batch.count()  # tracked webhooks only (S15), bodies verbatim
    assert archive.select("body").exceptAll(reqs.select("body")).count() == 0
    assert {r["event"] for r in archive.select("event").distinct().collect()} == {"invitee.created"}


def test_incremental_silver_only_new_files(spark, tmp_dir):
    bronze = f"{tmp_dir}/bronze"
    os.makedirs(bronze)
    rec = {"invitee_uri": "u1", "marketing_channel": "fb", "scheduled_event_start_time": "2024-01-01T10:00:00Z",
           "webhook_received_at": "2024-01-01T00:00:00Z", "scheduled_event_status": "active"}
    with open(f"{bronze}/a.json", "w") as f:
        f.write(json.dumps(rec) + "\n")
    silver, ckpt = f"{tmp_dir}/silver", f"{tmp_dir}/ckpt"
    J.run_to_end(J.bronze_to_silver_incremental(spark, bronze, silver, ckpt))
    assert spark.read.parquet(silver).count() == 1
    rec2 = dict(rec, invitee_uri="u2")
    upd = dict(rec, scheduled_event_start_time="2024-02-01T10:00:00Z", webhook_received_at="2024-01-05T00:00:00Z")
    with open(f"{bronze}/b.json", "w") as f:
        f.write(json.dumps(rec2) + "\n" + json.dumps(upd) + "\n")
    J.run_to_end(J.bronze_to_silver_incremental(spark, bronze, silver, ckpt))
    rows = {r["invitee_uri"]: r for r in spark.read.parquet(silver).collect()}
    assert set(rows) == {"u1", "u2"} and rows["u1"]["booking_month"] == 2
    # an older version in a later file does not replace the newer one
    old = dict(rec, scheduled_event_start_time="2024-03-01T10:00:00Z", webhook_received_at="2023-12-01T00:00:00Z")
    with open(f"{bronze}/c.json", "w") as f:
        f.write(json.dumps(old) + "\n")
    J.run_to_end(J.bronze_to_silver_incremental(spark, bronze, silver, ckpt))
    assert {r["invitee_uri"]: r["booking_month"] for r in spark.read.parquet(silver).collect()} == {"u1": 2, "u2": 1}


def test_redelivery_dedup_and_dead_letters(spark, tmp_dir):
    from slotflow.plans.registry import _envelopes

    env = _envelopes(spark, SF_SMALL).drop("event_id")
    env.write.json(f"{tmp_dir}/in")
    env.limit(20).write.mode("append").json(f"{tmp_dir}/in")  # redelivered records
    q = J.bronze_writer(spark, f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt",
                        trigger={"availableNow": True}, max_files_per_trigger=1)
    J.run_to_end(q)
    bronze = spark.read.schema(schemas.BRONZE_BOOKING).option("recursiveFileLookup", "true").json(f"{tmp_dir}/bronze")
    dead = spark.read.json(f"{tmp_dir}/dead") if os.path.exists(f"{tmp_dir}/dead") else None
    n_dead = dead.count() if dead is not None else 0
    assert bronze.count() + n_dead == env.count()
    assert bronze.select("event_id").distinct().count() == bronze.count()
    # per-batch counters from the query progress (S21): they add up to the decoded records
    seen = [p["observedMetrics"]["bronze_batch"] for p in q.recentProgress if "bronze_batch" in p.get("observedMetrics", {})]
    assert sum(m["processed"] for m in seen) == bronze.count() and sum(m["failed"] for m in seen) == n_dead


def test_daily_counts_are_complete(spark, tmp_dir):
    """Rows far ahead, far behind and delivered again, over several micro-batches."""
    bronze = f"{tmp_dir}/bronze"
    os.makedirs(bronze)

    def put(name, rows):
        with open(f"{bronze}/{name}.json", "w") as f:
            for uri, start in rows:
                f.write(json.dumps({"invitee_uri": uri, "marketing_channel": "fb", "scheduled_event_start_time": start}) + "\n")
        J.run_to_end(J.live_daily_counts(spark, bronze, f"{tmp_dir}/counts", f"{tmp_dir}/ckpt", trigger={"availableNow": True}))
        return {(r["date"].isoformat(), r["channel"]): r["total_bookings"] for r in spark.read.parquet(f"{tmp_dir}/counts").collect()}

    first = [("u1", "2024-01-10T10:00:00Z"), ("u2", "2024-06-10T10:00:00Z"), ("bad", "soon")]
    assert put("a", first) == {("2024-01-10", "fb"): 1, ("2024-06-10", "fb"): 1}
    second = [("u3", "2024-01-10T12:00:00Z"), ("u4", "2024-01-11T12:00:00Z"), ("u5", "2024-06-10T12:00:00Z")]
    want = {("2024-01-10", "fb"): 2, ("2024-01-11", "fb"): 1, ("2024-06-10", "fb"): 2}
    assert put("b", second) == want
    assert put("a-again", first) == want


def test_files_of_any_age_are_read_and_latest_starts_later(spark, tmp_dir):
    from slotflow.plans.registry import _envelopes

    env = _envelopes(spark, SF_SMALL).drop("event_id").limit(10).collect()
    frame = lambda rows: spark.createDataFrame(rows, "data string, sequence_number string, partition_key string, arrival_ts double").coalesce(1)

    def age(days):
        for d, _, names in os.walk(f"{tmp_dir}/in"):
            for n in names:
                os.utime(f"{d}/{n}", (os.path.getmtime(f"{d}/{n}") - days * 86400,) * 2)

    def run(out, start):
        q = J.bronze_writer(spark, f"{tmp_dir}/in", f"{tmp_dir}/{out}", f"{tmp_dir}/dead-{out}", f"{tmp_dir}/ckpt-{out}", {"availableNow": True}, start=start)
        J.run_to_end(q)
        path = f"{tmp_dir}/{out}"
        return spark.read.option("recursiveFileLookup", "true").json(path).count() if os.path.exists(path) else 0

    frame(env[:4]).write.json(f"{tmp_dir}/in")
    age(60)
    assert run("latest", "latest") == 0 and run("all", "earliest") == 4
    frame(env[4:]).write.mode("append").json(f"{tmp_dir}/in")
    assert run("latest", "latest") == 6 and run("all", "earliest") == 10


def test_compaction_keeps_rows(spark, tmp_dir):
    from slotflow.operators.projections import tag_decode_errors
    from slotflow.plans.registry import _envelopes

    env = tag_decode_errors(_envelopes(spark, SF_SMALL).drop("event_id"))
    for k in (0, 1):
        J.write_bronze_batch(env.where(F.crc32("sequence_number") % 2 == k), f"{tmp_dir}/bronze", f"{tmp_dir}/dead", batch_id=k)
    read = lambda: spark.read.schema(schemas.BRONZE_BOOKING).option("recursiveFileLookup", "true").json(f"{tmp_dir}/bronze")
    before = sorted(r["event_id"] for r in read().select("event_id").collect())
    dates = {d.split("=")[1] for ch in os.listdir(f"{tmp_dir}/bronze") if "=" in ch for d in os.listdir(f"{tmp_dir}/bronze/{ch}") if "=" in d}
    assert sum(J.compact_bronze(spark, f"{tmp_dir}/bronze", d) for d in dates) > 0
    assert sorted(r["event_id"] for r in read().select("event_id").collect()) == before
    assert sum(J.compact_bronze(spark, f"{tmp_dir}/bronze", d) for d in dates) == 0


def test_unwrap_body_shapes(spark):
    """Body as JSON text, as an object, or the request itself is the webhook."""
    from slotflow.operators.projections import unwrap_body

    text = spark.createDataFrame([('{"event": "invitee.created", "payload": {"uri": "u1"}}',)], "body string")
    assert unwrap_body(text).select("event", "payload.uri").first() == ("invitee.created", "u1")
    whole = spark.createDataFrame([(("invitee.created", ("u4",)),)], "body struct<event:string, payload:struct<uri:string>>")
    assert unwrap_body(whole).select("event", "payload.uri").first() == ("invitee.created", "u4")
    direct = spark.createDataFrame([("invitee.created", "2024-01-01T00:00:00Z", ("u2",))],
                                   "event string, created_at string, payload struct<uri:string>")
    assert unwrap_body(direct).select("event", "payload.uri").first() == ("invitee.created", "u2")
    mixed = spark.createDataFrame([('{"event": "invitee.created", "payload": {"uri": "u3"}}', None), (None, "invitee.canceled")],
                                  "body string, event string")
    rows = sorted((r[0], r[1]) for r in unwrap_body(mixed).select("event", "payload.uri").collect())
    assert rows == [("invitee.canceled", None), ("invitee.created", "u3")]


def test_replayed_bronze_batch_is_written_once(spark, tmp_dir):
    """A micro-batch written twice (a replay after a failure) leaves one copy of its rows."""
    from pyspark.sql import functions as F
    from slotflow.operators.projections import tag_decode_errors
    from slotflow.plans.registry import _envelopes

    env = tag_decode_errors(_envelopes(spark, SF_SMALL).drop("event_id"))
    J.write_bronze_batch(env, f"{tmp_dir}/bronze", f"{tmp_dir}/dead", batch_id=7)
    J.write_bronze_batch(env, f"{tmp_dir}/bronze", f"{tmp_dir}/dead", batch_id=7)
    J.write_bronze_batch(env.limit(0), f"{tmp_dir}/bronze", f"{tmp_dir}/dead", batch_id=8)
    bronze = spark.read.schema(schemas.BRONZE_BOOKING).option("recursiveFileLookup", "true").json(f"{tmp_dir}/bronze")
    assert bronze.count() == env.filter(F.col("error").isNull()).count() > 0
