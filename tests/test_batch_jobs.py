"""File round trips: upsert on disk, bronze -> silver -> gold, spend ingestion, run log."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from slotflow.config import PipelineConfig
from slotflow.plans.batch_jobs import bronze_to_silver, ingest_spend, silver_to_gold
from slotflow.sources import tables

D = dt.date


def test_upsert_moves_partition_and_deletes_emptied(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    first = spark.createDataFrame([("a", 2024, 1, "fb", 1), ("b", 2024, 1, "fb", 1), ("c", 2024, 2, "yt", 1)],
                                  "invitee_uri string, booking_year int, booking_month int, marketing_channel string, v int")
    tables.upsert_table(spark, path, first, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    # c moves from (2024, 2, yt) to (2024, 3, yt): its old partition becomes empty and is removed
    upd = spark.createDataFrame([("c", 2024, 3, "yt", 2), ("d", 2024, 1, "fb", 2)],
                                "invitee_uri string, booking_year int, booking_month int, marketing_channel string, v int")
    res = tables.upsert_table(spark, path, upd, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    assert res["rows"] == 2
    rows = {r["invitee_uri"]: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert rows["c"]["booking_month"] == 3 and rows["c"]["v"] == 2
    assert not os.path.exists(f"{path}/booking_year=2024/booking_month=2/marketing_channel=yt")
    # same update again: idempotent
    tables.upsert_table(spark, path, upd, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    assert spark.read.parquet(path).count() == 4


def _write_bronze_booking(root, channel, date, event_id, payload):
    d = f"{root}/bookings/channel={channel}/date={date}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{event_id}.json", "w") as f:
        json.dump(payload, f, indent=2)


def test_bronze_to_silver_to_gold(spark, tmp_dir):
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_test")
    base = {"webhook_event": "invitee.created", "invitee_email": "x@y", "scheduled_event_status": "active",
            "host_email": "h@y", "host_name": "Host"}
    _write_bronze_booking(cfg.bronze_root, "fb", "2024-01-01", "e1", dict(base, invitee_uri="u1", marketing_channel="fb",
                          webhook_received_at="2024-01-01T00:00:00Z", scheduled_event_start_time="2024-01-01T10:00:00Z", invitee_name="Ann Lee"))
    # the same invitee delivered twice: the later one wins (Q5)
    _write_bronze_booking(cfg.bronze_root, "fb", "2024-01-02", "e2", dict(base, invitee_uri="u1", marketing_channel="fb",
                          webhook_received_at="2024-01-02T00:00:00Z", scheduled_event_start_time="2024-01-02T10:00:00Z", invitee_name="Ann Lee"))
    # a partition value that differs from the record's field does not shadow it (Q10)
    _write_bronze_booking(cfg.bronze_root, "wrong", "2024-01-01", "e3", dict(base, invitee_uri="u2", marketing_channel="yt",
                          webhook_received_at="2024-01-01T00:00:00Z", scheduled_event_start_time="2024-01-01T11:00:00Z"))
    os.makedirs(f"{cfg.bronze_spend}/channel=fb/date=2024-01-01", exist_ok=True)
    with open(f"{cfg.bronze_spend}/channel=fb/date=2024-01-01/spend_data.json", "w") as f:
        json.dump({"records": [{"date": "2024-01-01", "channel": "fb", "spend": 30.0, "ingested_at": "2024-01-02T00:00:00Z"}],
                   "metadata": {"record_count": 1, "channel": "fb", "date": "2024-01-01"}}, f, indent=2)
    with open(f"{cfg.bronze_spend}/channel=fb/date=2024-01-01/broken.json", "w") as f:
        f.write("{not json")
    counts = bronze_to_silver(spark, cfg)
    assert counts == {"bookings": 2, "spend": 1, "unreadable": 1}
    silver = {r["invitee_uri"]: r for r in spark.read.parquet(cfg.silver_bookings).collect()}
    assert silver["u1"]["booking_date"] == D(2024, 1, 2)
    assert silver["u2"]["marketing_channel"] == "yt"
    again = bronze_to_silver(spark, cfg)  # idempotent
    assert again["bookings"] == 2 and spark.read.parquet(cfg.silver_bookings).count() == 2
    errors = []
    out = silver_to_gold(spark, cfg, errors=errors)
    assert not errors and out["cost_per_booking"] >= 1 and out["employee_meeting_load"] == 1
    cpb = {(r["date"], r["channel"]): r for r in spark.read.parquet(f"{cfg.gold_metrics}/cost_per_booking").collect()}
    assert cpb[(D(2024, 1, 1), "fb")]["total_spend"] == 30.0 and cpb[(D(2024, 1, 1), "fb")]["total_bookings"] == 0
    assert spark.sql("SHOW TABLES IN slotflow_test").count() >= 6
    # the silver tables registered over partitioned folders are queryable through the catalog
    assert spark.table("slotflow_test.bookings_silver").count() == 2
    assert spark.table("slotflow_test.marketing_spend_silver").filter("channel = 'fb'").count() == 1
    # Tables are found under a root; a column added to one shows up on the next run
    assert tables.discover_tables(spark, "slotflow_found", cfg.silver_root) == {"bookings_silver": True, "marketing_spend_silver": True}
    found = spark.table("slotflow_found.bookings_silver")
    assert found.count() == 2 and "note" not in found.columns
    moved = spark.read.parquet(cfg.silver_bookings).where("invitee_uri = 'u2'").withColumn("note", F.lit("x"))
    tables.upsert_table(spark, cfg.silver_bookings, moved, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    assert tables.discover_tables(spark, "slotflow_found", cfg.silver_root)["bookings_silver"]
    notes = {r["invitee_uri"]: r["note"] for r in spark.table("slotflow_found.bookings_silver").collect()}
    assert notes == {"u1": None, "u2": "x"}


def test_ingest_spend_and_run_log(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for day, rows in {"2024-01-01": [("fb", 10.0), ("yt", 5.0)], "2024-01-02": [("fb", 7.5)]}.items():
        with open(f"{src}/spend_data_{day}.json", "w") as f:
            json.dump([{"channel": c, "date": day, "spend": s, "impressions": 100, "clicks": 3} for c, s in rows], f, indent=2)
    with open(f"{src}/spend_data_2024-01-03.json", "w") as f:
        f.write("[{broken")
    with open(f"{src}/file_index.txt", "w") as f:
        f.write("not a spend file")
    with open(f"{src}/spend_data_2023-12-31.json", "w") as f:
        f.write('[{"channel": "fb", "date": "2023-12-31", "spend": "2.5", "impressions": "many", "extra": {"a": [1]}}, 7]')
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_test2")
    for _ in range(2):  # a repeated run rewrites its own documents
        res = ingest_spend(spark, src, cfg, as_of="2024-01-04")
        assert res == {"execution_date": "2024-01-03", "files_processed": 4, "records_processed": 4, "records_failed": 2}
        docs = spark.read.option("recursiveFileLookup", "true").json(cfg.bronze_spend)
        assert docs.count() == 4  # one per date, channel and file
        records = {(r["date"], r["channel"]): r for r in docs.select(F.explode("records").alias("r")).select("r.*").collect()}
    # fields that nothing uses are kept with their values; a quoted spend is a spend
    assert records[("2024-01-01", "yt")]["clicks"] == "3" or records[("2024-01-01", "yt")]["clicks"] == 3
    assert records[("2023-12-31", "fb")]["extra"]["a"] == [1] and records[("2023-12-31", "fb")]["impressions"] == "many"
    bronze_to_silver(spark, cfg)
    silver = {(str(r["date"]), r["channel"]): r["spend"] for r in spark.read.parquet(cfg.silver_spend).collect()}
    assert silver == {("2024-01-01", "fb"): 10.0, ("2024-01-01", "yt"): 5.0, ("2024-01-02", "fb"): 7.5, ("2023-12-31", "fb"): 2.5}
    dead = spark.read.json(cfg.spend_dead_letters).collect()
    assert sorted((r["source_file"], r["error"], r["body"]) for r in dead) == [
        ("spend_data_2023-12-31.json", "not a JSON object", "7"), ("spend_data_2024-01-03.json", "not a JSON array", "[{broken")]
    runs = tables.read_runs(spark, cfg.run_log).collect()
    assert len(runs) == 1 and runs[0]["status"] == "completed" and runs[0]["records_processed"] == 4


def test_ingest_spend_without_files_and_backfill_date(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/src")
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_test5")
    res = ingest_spend(spark, f"{tmp_dir}/src", cfg, execution_date="2023-05-05")
    assert (res["execution_date"], res["records_processed"], res["records_failed"]) == ("2023-05-05", 0, 0)
    assert tables.read_runs(spark, cfg.run_log).first()["status"] == "completed"
    # nothing in silver: every metric is there, without rows
    errors = []
    out = silver_to_gold(spark, cfg, errors=errors)
    assert not errors and set(out.values()) == {0} and len(out) == 6


def test_config_requires_every_location():
    import pytest

    with pytest.raises(ValueError):
        PipelineConfig("", "s", "g", "db")
    with pytest.raises(ValueError):
        PipelineConfig("b", "s", "g", "  ")


def test_incremental_bronze_to_silver_reads_new_files_only(spark, tmp_dir):
    from slotflow.plans.batch_jobs import bronze_to_silver_incremental

    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_test3")
    base = {"webhook_event": "invitee.created", "scheduled_event_status": "active", "marketing_channel": "fb"}
    _write_bronze_booking(cfg.bronze_root, "fb", "2024-01-01", "e1", dict(base, invitee_uri="u1",
                          webhook_received_at="2024-01-01T00:00:00Z", scheduled_event_start_time="2024-01-01T10:00:00Z"))
    os.makedirs(f"{cfg.bronze_spend}/channel=fb/date=2024-01-01", exist_ok=True)
    with open(f"{cfg.bronze_spend}/channel=fb/date=2024-01-01/spend_data.json", "w") as f:
        json.dump({"records": [{"date": "2024-01-01", "channel": "fb", "spend": 3.0, "ingested_at": "2024-01-02T00:00:00Z"}]}, f)
    bronze_to_silver_incremental(spark, cfg)
    assert spark.read.parquet(cfg.silver_bookings).count() == 1 and spark.read.parquet(cfg.silver_spend).count() == 1
    _write_bronze_booking(cfg.bronze_root, "fb", "2024-01-03", "e2", dict(base, invitee_uri="u2",
                          webhook_received_at="2024-01-03T00:00:00Z", scheduled_event_start_time="2024-01-03T10:00:00Z"))
    os.makedirs(f"{cfg.bronze_spend}/channel=fb/date=2024-01-03", exist_ok=True)
    with open(f"{cfg.bronze_spend}/channel=fb/date=2024-01-03/spend_data.json", "w") as f:
        json.dump({"records": [{"date": "2024-01-01", "channel": "fb", "spend": 4.0, "ingested_at": "2024-01-04T00:00:00Z"}]}, f)
    bronze_to_silver_incremental(spark, cfg)
    assert {r["invitee_uri"] for r in spark.read.parquet(cfg.silver_bookings).collect()} == {"u1", "u2"}
    spend = spark.read.parquet(cfg.silver_spend).collect()
    assert len(spend) == 1 and spend[0]["spend"] == 4.0  # the later version of (2024-01-01, fb)


def test_ingest_spend_uses_file_index(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    os.makedirs(src)
    for day in ["2024-01-01", "2024-01-02", "2024-01-03"]:
        with open(f"{src}/spend_data_{day}.json", "w") as f:
            json.dump([{"channel": "fb", "date": day, "spend": 1.0}], f)
    # the index names only two of the three files (and one that does not exist)
    with open(f"{src}/file_index.json", "w") as f:
        json.dump({"files": ["spend_data_2024-01-01.json", "spend_data_2024-01-03.json", "spend_data_2023-12-31.json", "readme.txt"]}, f)
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_test4")
    res = ingest_spend(spark, src, cfg, as_of="2024-01-05", lookback_days=30)
    assert res["files_processed"] == 3 and res["records_processed"] == 2


def test_hot_partition_is_written_by_several_tasks(spark, tmp_dir):
    """One channel holds a third of all rows: the REBALANCE before a partitioned write lets
    AQE split that folder's rows over several tasks (several files) and pack the small
    folders (the advisory size is lowered so that local data counts as large)."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        df = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("channel"),
            F.col("id").alias("invitee_uri"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        path = f"{tmp_dir}/t"
        tables.write_partitioned(df, path, ["channel"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = lambda d: [f for f in os.listdir(f"{path}/channel={d}") if f.endswith(".parquet")]
    assert len(files("hot")) > 2
    assert max(len(files(f"c{i}")) for i in range(1, 40, 3)) <= len(files("hot"))
    assert spark.read.parquet(path).count() == 60000


def test_upsert_adds_a_column(spark, tmp_dir):
    """A batch with a new column evolves the table; older rows read it as null."""
    from slotflow.sources.readers import read_silver

    path = f"{tmp_dir}/t"
    base = spark.createDataFrame([("a", 2024, 1, "fb"), ("b", 2024, 2, "yt")],
                                 "invitee_uri string, booking_year int, booking_month int, marketing_channel string")
    tables.upsert_table(spark, path, base, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    upd = spark.createDataFrame([("c", 2024, 1, "fb", "+1")],
                                "invitee_uri string, booking_year int, booking_month int, marketing_channel string, invitee_phone string")
    tables.upsert_table(spark, path, upd, ["invitee_uri"], tables.BOOKING_PARTITIONS)
    rows = {r["invitee_uri"]: r for r in read_silver(spark, path).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["c"]["invitee_phone"] == "+1" and rows["b"]["invitee_phone"] is None
    # a later upsert that lacks the column keeps it
    tables.upsert_table(spark, path, base.limit(1), ["invitee_uri"], tables.BOOKING_PARTITIONS)
    assert "invitee_phone" in read_silver(spark, path).columns


def test_upsert_after_other_writes_and_null_partitions(spark, tmp_dir):
    """Moved keys are found wherever they are, also after the table was written by other means;
    null partition values and values that need escaping are partitions like any other."""
    from slotflow.operators.windows import latest_first
    from slotflow.sources.readers import read_silver

    path = f"{tmp_dir}/t"
    sch = "invitee_uri string, booking_year int, booking_month int, marketing_channel string, v int"
    frame = lambda rows: spark.createDataFrame(rows, sch)
    up = lambda rows: tables.upsert_table(spark, path, frame(rows), ["invitee_uri"], tables.BOOKING_PARTITIONS, latest_first("v", []))
    up([(f"u{i}", 2024, 1 + i % 12, "fb", 0) for i in range(50)] + [("n", None, None, "fb", 0)])
    up([("u1", 2025, 6, "a/b: c", 1), ("n", 2024, 3, "fb", 1)])
    rows = {r["invitee_uri"]: r for r in read_silver(spark, path).collect()}
    assert len(rows) == 51 == read_silver(spark, path).count()
    assert (rows["u1"]["marketing_channel"], rows["u1"]["v"]) == ("a/b: c", 1) and rows["n"]["booking_month"] == 3
    # an older version arrives late and loses; a newer one wins
    up([("u1", 2026, 1, "fb", 0), ("u2", 2026, 1, "fb", 5)])
    rows = {r["invitee_uri"]: r for r in read_silver(spark, path).collect()}
    assert rows["u1"]["booking_year"] == 2025 and rows["u2"]["booking_year"] == 2026 and len(rows) == 51
    # a full rewrite, then a move
    tables.write_silver_bookings(frame([("k1", 2024, 1, "fb", 1), ("k2", 2024, 2, "fb", 1)]), path)
    up([("k2", 2024, 3, "fb", 2)])
    assert sorted((r["invitee_uri"], r["booking_month"]) for r in read_silver(spark, path).collect()) == [("k1", 1), ("k2", 3)]


def test_bronze_dates_prune_folders(spark, tmp_dir):
    """A range of dates reads only those folders' files."""
    from slotflow.sources.readers import read_bronze_bookings

    for k, date in enumerate(["2024-01-01", "2024-01-02", "2024-02-01"]):
        _write_bronze_booking(f"{tmp_dir}/bronze", "fb", date, f"e{k}", {"invitee_uri": f"u{k}", "marketing_channel": "own"})
    df = read_bronze_bookings(spark, f"{tmp_dir}/bronze/bookings").where("date_part >= '2024-01-02' AND date_part < '2024-02-01'")
    assert [(r["invitee_uri"], r["marketing_channel"], r["channel_part"]) for r in df.collect()] == [("u1", "own", "fb")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_bronze_accepts_flat_and_nested_bookings(spark, tmp_dir):
    """Q11: the nested webhook document (webhook kept under payload.payload, no top-level
    invitee_uri) and the flat bronze record normalize through one reader and one cleaner.
    Q10: a spend file filed under another channel's folder keeps its own channel."""
    from slotflow.plans.normalize import clean_bookings, clean_spend
    from slotflow.sources.readers import read_bronze_bookings, read_bronze_spend

    root = f"{tmp_dir}/bronze"
    nested = {
        "webhook_event": "invitee.created", "webhook_received_at": "2024-02-17T10:30:00Z",
        "marketing_channel": "search_ads", "event_type_url": "https://example.com/event_types/a",
        "payload": {"event": "invitee.created", "time": "2024-02-17T10:30:00.000000Z", "payload": {
            "uri": "https://example.com/invitees/n1", "email": "n1@example.com", "name": "Nia Lopez",
            "status": "active", "timezone": "America/New_York", "canceled": True, "rescheduled": False,
            "created_at": "2024-02-17T10:30:00.000000Z", "updated_at": "2024-02-17T11:00:00.000000Z",
            "questions_and_answers": [{"question": "Phone", "answer": "+1 555 0100"}],
            "tracking": {"utm_source": "search", "utm_medium": "paid", "utm_campaign": "spring", "utm_content": None},
            "scheduled_event": {"name": "30 Minute Meeting", "start_time": "2024-02-17T15:00:00.000000Z",
                                "end_time": "2024-02-17T15:30:00.000000Z", "status": "active",
                                "event_type": "https://example.com/event_types/a",
                                "location": {"type": "zoom", "join_url": "https://example.com/j"},
                                "event_memberships": [{"user": "https://example.com/users/u1"}],
                                "invitees_counter": {"active": 1, "limit": 1, "total": 1}}}}}
    flat = {"invitee_uri": "f1", "invitee_email": "f1@example.com", "invitee_name": "Solo", "marketing_channel": "video_ads",
            "scheduled_event_start_time": "2024-02-18T09:00:00Z", "scheduled_event_status": "active",
            "host_email": "h@example.com", "host_name": "Host A"}
    _write_bronze_booking(root, "search_ads", "2024-02-17", "n1", nested)
    _write_bronze_booking(root, "video_ads", "2024-02-18", "f1", flat)
    silver = {r["invitee_uri"]: r for r in clean_bookings(read_bronze_bookings(spark, f"{root}/bookings")).collect()}
    n = silver["https://example.com/invitees/n1"]
    assert (n["invitee_email"], n["invitee_first_name"], n["invitee_last_name"]) == ("n1@example.com", "Nia", "Lopez")
    assert n["invitee_canceled"] is True and n["invitee_phone"] == "+1 555 0100" and n["utm_campaign"] == "spring"
    assert (n["booking_date"], n["booking_hour"], n["marketing_channel"]) == (D(2024, 2, 17), 15, "search_ads")
    assert n["host_email"] is None and n["scheduled_event_name"] == "30 Minute Meeting" and n["webhook_event"] == "invitee.created"
    f = silver["f1"]
    assert f["host_name"] == "Host A" and f["booking_date"] == D(2024, 2, 18) and f["invitee_last_name"] == ""
    # Q10: the same spend file under two channel folders; each record keeps its own channel
    for ch in ("search_ads", "video_ads"):
        d = f"{root}/marketing_spend/channel={ch}/date=2024-02-17"
        os.makedirs(d, exist_ok=True)
        with open(f"{d}/spend_data.json", "w") as fh:
            json.dump([{"channel": "search_ads", "date": "2024-02-17", "spend": 150.0, "impressions": 5000, "clicks": 250},
                       {"channel": "video_ads", "date": "2024-02-17", "spend": 200.0, "impressions": 8000, "clicks": 400}], fh, indent=2)
    spend = {r["channel"]: r["spend"] for r in clean_spend(read_bronze_spend(spark, f"{root}/marketing_spend"), clock=False).collect()}
    assert spend == {"search_ads": 150.0, "video_ads": 200.0}
