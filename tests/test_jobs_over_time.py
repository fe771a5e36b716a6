"""Jobs that run again and again: bookmarks, compaction, ordered messages, late starts, counters,
live counts with few files, upserts with a key filter."""

import json
import os

from pyspark.sql import functions as F

from slotflow import schemas
from slotflow.config import PipelineConfig
from slotflow.operators.projections import tag_decode_errors
from slotflow.operators.upsert import held_keys
from slotflow.plans.batch_jobs import bronze_to_silver
from slotflow.plans.registry import QUERIES, _envelopes
from slotflow.sources import readers, tables
from slotflow.sources.bookmarks import Bookmark
from slotflow.streaming import counters, jobs as J
from conftest import SF_SMALL


def put(root, channel, date, name, row):
    folder = f"{root}/channel={channel}/date={date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write(json.dumps(row) + "\n")


def booking(uri, day, received="2024-01-01T00:00:00Z"):
    return {"invitee_uri": uri, "webhook_event": "invitee.created", "marketing_channel": "fb", "webhook_received_at": received,
            "scheduled_event_status": "active", "scheduled_event_start_time": f"{day}T10:00:00Z"}


def test_bookmark_reads_changed_dates_only(spark, tmp_dir):
    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_marks")
    put(cfg.bronze_bookings, "fb", "2024-01-01", "a", booking("u1", "2024-01-01"))
    put(cfg.bronze_bookings, "fb", "2024-01-02", "b", booking("u2", "2024-01-02"))
    put(cfg.bronze_spend, "fb", "2024-01-01", "s", {"records": [{"date": "2024-01-01", "channel": "fb", "spend": 2.0, "ingested_at": "2024-01-02T00:00:00Z"}]})
    run = lambda bookmark=True: bronze_to_silver(spark, cfg, multiline=False, bookmark=bookmark)
    assert run() == {"bookings": 2, "spend": 1, "unreadable": 0, "dates": 2}
    assert run() == {"bookings": 0, "spend": 0, "unreadable": 0, "dates": 0}
    # a file more in an old folder, and a new day
    put(cfg.bronze_bookings, "fb", "2024-01-01", "c", booking("u3", "2024-01-01"))
    put(cfg.bronze_bookings, "yt", "2024-01-03", "d", booking("u4", "2024-01-03"))
    put(cfg.bronze_spend, "fb", "2024-01-04", "s", {"records": [{"date": "2024-01-04", "channel": "fb", "spend": 3.0, "ingested_at": "2024-01-05T00:00:00Z"}]})
    mark = Bookmark(spark, cfg.bookmarks, "bookings", cfg.bronze_bookings)
    assert mark.dates == ["2024-01-01", "2024-01-03"]
    plan = readers.read_bronze_bookings(spark, cfg.bronze_bookings, False, mark.dates)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(readers.read_bronze_bookings(spark, cfg.bronze_bookings, False, mark.dates).inputFiles()) >= 3
    assert run() == {"bookings": 3, "spend": 1, "unreadable": 0, "dates": 2}
    assert {r[0] for r in spark.read.parquet(cfg.silver_bookings).select("invitee_uri").collect()} == {"u1", "u2", "u3", "u4"}
    assert run(bookmark=False)["bookings"] == 4


def test_a_run_that_dies_keeps_the_old_bookmark(spark, tmp_dir, monkeypatch):
    import pytest

    cfg = PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "slotflow_marks2")
    put(cfg.bronze_bookings, "fb", "2024-01-01", "a", booking("u1", "2024-01-01"))
    monkeypatch.setattr(Bookmark, "keep", lambda self: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        bronze_to_silver(spark, cfg, multiline=False, bookmark=True)
    monkeypatch.undo()
    assert bronze_to_silver(spark, cfg, multiline=False, bookmark=True)["bookings"] == 1
    assert spark.read.parquet(cfg.silver_bookings).count() == 1


def test_compaction_that_dies_leaves_every_row_once(spark, tmp_dir):
    env = tag_decode_errors(_envelopes(spark, SF_SMALL).drop("event_id")).cache()
    bronze = f"{tmp_dir}/bronze"
    read = lambda: sorted(r["event_id"] for r in readers.read_bronze_bookings(spark, bronze, multiline=False).select("event_id").collect())
    part = lambda k: env.where(F.crc32("sequence_number") % 3 == k)
    for k in (0, 1):
        J.write_bronze_batch(part(k), bronze, f"{tmp_dir}/dead", batch_id=k)
    want = read()
    assert len(set(want)) == len(want) > 0
    J.compact_bronze(spark, bronze, "*", remove=False)  # died before removing anything
    assert read() == want
    J.write_bronze_batch(part(2), bronze, f"{tmp_dir}/dead", batch_id=2)
    every = read()
    assert len(set(every)) == len(every) == env.where("error IS NULL").count()
    # a generation without its _SUCCESS (died while writing) does not count
    torn = [f"{d}/{n}" for d, names, _ in os.walk(bronze) for n in names if n.startswith("batch=upto-")]
    unfinished = torn[0].replace("upto-1", "upto-2")
    os.makedirs(unfinished)
    with open(f"{unfinished}/part-0.json", "w") as f:
        f.write(json.dumps({"event_id": "torn", "invitee_uri": "torn"}))
    assert read() == every
    assert J.compact_bronze(spark, bronze, "*") > 0 and read() == every
    folders = [n for _, names, _ in os.walk(bronze) for n in names if n.startswith("batch=")]
    assert all(n.startswith("batch=upto-") for n in folders)
    assert J.compact_bronze(spark, bronze, "*") == 0


def test_live_counts_leave_few_files(spark, tmp_dir):
    """Many micro-batches over the same days: the table's files do not grow with their number, and
    a batch that runs again changes nothing."""
    bronze, counts = f"{tmp_dir}/bronze", f"{tmp_dir}/counts"
    os.makedirs(bronze)
    files = lambda: sum(len([n for n in names if n.endswith(".parquet")]) for _, _, names in os.walk(counts))
    sizes, n = [], 0
    for run in range(3):
        for _ in range(8):
            with open(f"{bronze}/{n}.json", "w") as f:
                for k in range(5):
                    f.write(json.dumps({"event_id": f"e{n}-{k % 4}", "marketing_channel": f"c{k % 2}", "scheduled_event_start_time": f"202{k % 3}-01-0{1 + n % 9}T10:00:00Z"}) + "\n")
            n += 1
        query = J.live_daily_counts(spark, bronze, counts, f"{tmp_dir}/ckpt", {"availableNow": True}, max_files_per_trigger=1)
        J.run_to_end(query)
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 8
        sizes.append(files())
        records = spark.read.json(bronze)
        want = records.groupBy(F.to_date(F.col("scheduled_event_start_time").cast("timestamp")).alias("date"), F.col("marketing_channel").alias("channel")).agg(F.countDistinct("event_id").alias("n"))
        table = spark.read.parquet(counts)
        assert table.select("date", "channel", "total_bookings").exceptAll(want).count() == 0 and table.count() == want.count()
    assert sizes[1] == sizes[2] <= 3 * 8 and not os.path.exists(f"{counts}_ids")
    # the last batch again
    last = spark.read.parquet(counts).agg(F.max("batch")).first()[0]
    before = sorted(map(tuple, table.select("date", "channel", "total_bookings").collect()))
    again = J.booking_ids(spark.read.schema(schemas.BRONZE_BOOKING).json(f"{bronze}/{n - 1}.json")).dropDuplicates()
    cells = {(str(r["date"]), r["channel"]): r for r in table.where(F.col("batch") == last).collect()}
    own = again.groupBy("date", "channel").count().collect()
    assert all(cells[str(r["date"]), r["channel"]]["total_bookings"] - cells[str(r["date"]), r["channel"]]["before"] == r["count"] for r in own)
    J.count_batch(spark, again, last, counts)
    assert sorted(map(tuple, spark.read.parquet(counts).select("date", "channel", "total_bookings").collect())) == before


def test_latest_lists_old_files_and_does_not_read_them(spark, tmp_dir):
    env = _envelopes(spark, SF_SMALL).drop("event_id").limit(10).collect()
    frame = lambda rows: spark.createDataFrame(rows, "data string, sequence_number string, partition_key string, arrival_ts double").coalesce(1)
    run = lambda: J.bronze_writer(spark, f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", {"availableNow": True}, start="latest")
    frame(env[:4]).write.json(f"{tmp_dir}/in")
    first = run()
    J.run_to_end(first)
    assert sum(p["numInputRows"] for p in first.recentProgress) == 0
    frame(env[4:]).write.mode("append").json(f"{tmp_dir}/in")
    query = run()
    J.run_to_end(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [6]


def test_messages_are_ordered_files(spark, tmp_dir):
    """Files in the order of their names hold each key's messages in the order of arrival."""
    QUERIES["message_order"](spark, SF_SMALL)  # builds its own folders
    from slotflow.sources import adapters as AD

    AD.events_requests(spark, SF_SMALL).coalesce(1).sortWithinPartitions("event_id").select("body").write.text(f"{tmp_dir}/requests")
    J.run_to_end(J.webhook_intake(spark, f"{tmp_dir}/requests", f"{tmp_dir}/messages", f"{tmp_dir}/archive", f"{tmp_dir}/ckpt",
                                  AD.FIXTURE_EVENT_TYPE_CHANNELS, trigger={"availableNow": True}))
    rows = []
    folder = f"{tmp_dir}/messages/batch=0"
    for name in sorted(n for n in os.listdir(folder) if n.startswith("part-")):
        with open(f"{folder}/{name}") as f:
            rows += [json.loads(line) for line in f]
    assert len(rows) > 100
    order = [(r["key"], r["sequence"]["place"]) for r in rows]
    assert order == sorted(order)
    ids = {}
    for r in rows:
        ids.setdefault(r["key"], []).append(int(json.loads(r["value"])["invitee_data"]["uri"].split("-")[1]))
    assert all(v == sorted(v) for v in ids.values())


def test_counters_count_a_batch_once(spark, tmp_dir):
    env = _envelopes(spark, SF_SMALL).drop("event_id")
    env.repartition(3).write.json(f"{tmp_dir}/in")
    listener = counters.Counters(spark, f"{tmp_dir}/counters")
    spark.streams.addListener(listener)
    try:
        for _ in range(2):  # the second run has nothing to do
            q = J.bronze_writer(spark, f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/dead", f"{tmp_dir}/ckpt", {"availableNow": True}, max_files_per_trigger=1)
            J.run_to_end(q)
            listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    kept = counters.read_counters(spark, f"{tmp_dir}/counters").collect()
    total = {n: sum(r["value"] for r in kept if r["name"] == n) for n in ("processed", "failed")}
    assert total["processed"] + total["failed"] == env.count() and {0, 1, 2} <= {r["batch"] for r in kept}


def test_key_filter_thins_the_table_above_its_scan(spark, tmp_dir):
    spark.range(20000).select(F.concat(F.lit("u"), "id").alias("k"), (F.col("id") % 5).alias("p")).write.partitionBy("p").parquet(f"{tmp_dir}/t")
    table = spark.read.parquet(f"{tmp_dir}/t")
    source = spark.range(100).select(F.concat(F.lit("u"), F.col("id") * 7 + 3).alias("k"))
    got = held_keys(table, source, ["k"], 100)
    assert sorted(r["k"] for r in got.collect()) == sorted(f"u{7 * i + 3}" for i in range(100))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = held_keys(table, source, ["k"], 100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # scan, then the broadcast filter, and only then the shuffle to the exact join
    below = plan[plan.index("SortMergeJoin"):]
    assert below.index("Exchange hashpartitioning") < below.index("BroadcastHashJoin") < below.index("FileScan parquet")
    # a batch that fills the slots is joined directly, and rows are the same
    assert held_keys(table, source, ["k"], 100, slots=64).count() == 100


def test_registered_table_gains_columns_in_place(spark, tmp_dir):
    spark.range(3).select("id", F.lit(1).alias("p")).write.partitionBy("p").parquet(f"{tmp_dir}/t")
    assert tables.register_table(spark, "slotflow_cols", "t", f"{tmp_dir}/t")
    spark.range(2).select("id", F.lit("x").alias("extra"), F.lit(2).alias("p")).write.mode("append").partitionBy("p").parquet(f"{tmp_dir}/t")
    created = spark.sql("DESCRIBE EXTENDED slotflow_cols.t").where("col_name = 'Created Time'").first()
    assert tables.register_table(spark, "slotflow_cols", "t", f"{tmp_dir}/t")
    assert spark.sql("DESCRIBE EXTENDED slotflow_cols.t").where("col_name = 'Created Time'").first() == created
    assert spark.table("slotflow_cols.t").count() == 5 and spark.table("slotflow_cols.t").where("extra = 'x'").count() == 2


def test_message_places_are_numbered_in_splits(spark, monkeypatch):
    """A lot of requests is several files, a channel's places come from several splits; no task
    holds a channel or a lot, and the places are those of a plain row number."""
    from slotflow.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_A_SPLIT", 20)
    rows = QUERIES["message_order"](spark, SF_SMALL)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_id % 4 <> 0")
    channels = {"purchase": "search_ads", "signup": "social_ads", "view": "video_ads"}
    want = {}
    for r in sorted(events.where(F.col("event_type").isin(*channels)).collect(), key=lambda r: r["event_id"]):
        want.setdefault(channels[r["event_type"]], []).append(r["event_id"])
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r["key"], r["place"])):
        got.setdefault(r["key"], []).append((r["place"], r["event_id"]))
    assert got == {k: list(enumerate(v, 1)) for k, v in want.items()}
    folders = [p.split("/s16-")[1].split("/")[0] for p in rows.inputFiles() if "/s16-" in p]
    assert not folders  # the rows come from the numbered splits
    files = sorted(rows.inputFiles())
    assert len([f for f in files if "/numbered-" in f and "/numbered-groups-" not in f]) > 8


def test_number_in_groups(spark):
    """Against row_number: a group over many splits, groups within one, null keys, no rows."""
    from pyspark.sql import Window
    from slotflow.operators.ordering import number_in_groups

    df = spark.range(5000).select(F.when(F.col("id") % 50 == 7, None).otherwise(F.when(F.col("id") % 10 < 8, "big").otherwise(F.concat(F.lit("k"), F.col("id") % 37))).alias("k"),
                                  (F.col("id") * 7919 % 5003).alias("o")).repartition(5)
    got = number_in_groups(df, ["k"], ["o"], "n", rows_a_split=100)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("long"))
    assert got.count() == 5000 and got.exceptAll(want).count() == 0
    assert number_in_groups(df.where("false"), ["k"], ["o"], "n").count() == 0


def test_slices_of_live_counts_are_written_by_all_tasks(spark):
    """No slice of the daily counts' bronze passes one task, and the second is delivered twice."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "9000")  # a file has many splits
        rows = QUERIES["stream_daily_counts"](spark, SF_SMALL)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    base = rows.inputFiles()[0].removeprefix("file://").split("/counts/")[0]
    names = [n.rsplit("-", 1)[0] for n in os.listdir(f"{base}/bronze") if n.startswith("slice-")]
    files = {n: names.count(n) for n in set(names)}
    assert set(files) == {"slice-0", "slice-1", "slice-2", "slice-1-again"} and min(files.values()) > 1
    count = lambda n: spark.read.text(f"{base}/bronze/{n}-0*").count()
    assert count("slice-1") == count("slice-1-again") > 0
    # four micro-batches, of which the last adds nothing
    assert spark.read.parquet(f"{base}/counts").agg(F.max("batch")).first()[0] == 2


def test_compaction_copies_lines(spark, tmp_dir):
    """Fields that no schema names and lines that do not parse are in the compacted day as well; a
    channel that looks like a number keeps its folder."""
    lines = ['{"invitee_uri": "a", "utm": {"new": [1, 1.50]}}', "{broken", '{"invitee_uri":   "b"}']
    for batch, own in enumerate((lines[:2], lines[2:])):
        folder = f"{tmp_dir}/channel=007/date=2024-01-01/batch={batch}"
        os.makedirs(folder)
        with open(f"{folder}/x.json", "w") as f:
            f.write("\n".join(own) + "\n")
    assert J.compact_bronze(spark, tmp_dir, "*") == 2
    assert os.listdir(f"{tmp_dir}/channel=007/date=2024-01-01") == ["batch=upto-1"]
    assert sorted(r[0] for r in spark.read.option("recursiveFileLookup", "true").text(tmp_dir).collect()) == sorted(lines)
    read = readers.read_bronze_bookings(spark, tmp_dir, multiline=False)
    assert sorted((r["invitee_uri"] or "", r[schemas.CORRUPT] or "") for r in read.collect()) == [("", "{broken"), ("a", ""), ("b", "")]
