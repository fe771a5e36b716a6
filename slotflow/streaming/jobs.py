"""Structured Streaming jobs.

Sources are file streams (the container has no Kafka/Kinesis connector); each job takes a
``trigger`` dict so production runs ``{"processingTime": "10 seconds"}`` (the reference's
batching window) and tests run ``{"availableNow": True}``. Every job keeps its progress in a
checkpoint folder, so a restarted or retried job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from slotflow import schemas
from slotflow.operators.joins import attribute_channel
from slotflow.operators.ordering import splits_for
from slotflow.operators.projections import filter_event, flatten_booking, tag_decode_errors, unwrap_body
from slotflow.plans.normalize import clean_bookings
from slotflow.plans.webhooks import enriched_to_message, process_webhooks
from slotflow.sources import readers, tables
from slotflow.sources.staging import drop_staged, stage

PROCESSING_WINDOW = {"processingTime": "10 seconds"}
BYTES_A_SPLIT = 64 << 20  # of messages that a task sorts
DEDUP_DELAY = "24 hours"  # the stream's retention: a redelivery can arrive up to a day late


def _start(writer, trigger: dict | None):
    return writer.trigger(**(trigger or PROCESSING_WINDOW)).start()


# ---------------------------------------------------------------- T1, S15, S16
def webhook_archive(requests: DataFrame, event_type_channels: dict[str, str]) -> DataFrame:
    """The verbatim bodies of tracked webhooks (event kind and event type on the allow-list),
    by event kind and day. Other requests are not kept, so their text names no folders."""
    tracked = filter_event(unwrap_body(requests)).withColumn("event_type_url", F.col("payload.scheduled_event.event_type"))
    return attribute_channel(tracked, event_type_channels).select(
        "event", F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("received_date"), F.col("raw").alias("body")
    )


def write_messages(requests: DataFrame, messages_dir: str, event_type_channels: dict[str, str], batch_id: int) -> None:
    """S16, one micro-batch: keyed messages with their ``sequence`` (batch, arrival of the request's
    file, its name, place in it), written range-split and sorted by (key, sequence): the files of a
    batch, in the order of their names, hold each channel's messages in the order in which they
    came, and a channel with a third of all messages is written by several tasks, more of them in a
    larger batch. A batch that runs again rewrites its own folder."""
    order = F.struct(F.lit(batch_id).cast("long").alias("batch"), "arrived", "file", "block", F.monotonically_increasing_id().alias("place"))
    placed = requests.select("body", order.alias("sequence"))
    messages = enriched_to_message(process_webhooks(placed, event_type_channels, keep=["sequence"]), keep=["sequence"])
    messages = stage(messages, "messages")  # the range split looks at the rows twice
    width = splits_for(messages, messages.agg(F.sum(F.octet_length("value"))).first()[0], BYTES_A_SPLIT)
    ordered = messages.repartitionByRange(width, "key", "sequence").sortWithinPartitions("key", "sequence")
    ordered.write.mode("overwrite").json(f"{messages_dir.rstrip('/')}/batch={batch_id}")
    drop_staged(messages)


def read_messages(spark: SparkSession, messages_dir: str) -> DataFrame:
    """S16 read back: (key, sequence, value); within a key, ``sequence`` is the order of arrival."""
    schema = "key string, sequence struct<batch:long,arrived:timestamp,file:string,block:long,place:long>, value string"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(messages_dir)


def webhook_intake(
    spark: SparkSession,
    requests_dir: str,
    messages_dir: str,
    archive_dir: str,
    checkpoint: str,
    event_type_channels: dict[str, str],
    trigger: dict | None = None,
    max_files_per_trigger: int = 100,
) -> list[StreamingQuery]:
    """Request bodies (one JSON text per line) -> enriched, keyed messages in the order of each
    key (S16), plus the audit archive (S15). Both outputs are exactly-once, each with its own
    checkpoint."""
    text = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(requests_dir)
    raw = text.select(
        F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    )
    q1 = _start(
        raw.writeStream.option("checkpointLocation", f"{checkpoint}/messages").foreachBatch(
            lambda df, batch_id: write_messages(df, messages_dir, event_type_channels, batch_id)
        ),
        trigger,
    )
    q2 = _start(
        webhook_archive(raw.select("body"), event_type_channels).writeStream.format("json")
        .partitionBy("event", "received_date")
        .option("path", archive_dir)
        .option("checkpointLocation", f"{checkpoint}/archive"),
        trigger,
    )
    return [q1, q2]


# ---------------------------------------------------------------- T2, T3, T4, T5, S14
def dedup_redeliveries(envelopes: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """T4: a record delivered again (same sequence number) within ``delay`` of its first
    delivery is dropped. The state is keyed by sequence number and expires ``delay`` after a
    record was first seen (a processing-time watermark: the micro-batch timestamp), so no
    record is ever discarded as late, however its own timestamps are ordered."""
    return (
        envelopes.withColumn("_seen", F.current_timestamp())
        .withWatermark("_seen", delay)
        .dropDuplicatesWithinWatermark(["sequence_number"])
        .drop("_seen")
    )


def write_bronze_batch(tagged: DataFrame, bronze_dir: str, dead_letter_dir: str, batch_id: int = 0) -> None:
    """One micro-batch of T2 (rows already decoded and tagged): flatten good rows and write
    them to bronze partitioned ``channel=/date=`` (S14), the date being that of arrival: a batch
    fills one or two days' folders, however far apart its appointments lie. Bad rows go to the
    dead-letter folder (T3). The batch is persisted, so it is decoded once for both outputs.

    Each batch writes under its own ``batch=<id>`` folders with dynamic partition overwrite:
    a batch replayed after a failure (same offsets, same state, so the same rows) rewrites
    exactly its own folders, so the output is exactly-once."""
    # Persisted before any action: every row is decoded (and counted by the observation) once.
    tagged = tagged.persist()
    try:
        if tagged.isEmpty():  # no-data batches (watermark advances) have nothing to write
            return
        good = flatten_booking(tagged.filter(F.col("error").isNull()))
        out = good.withColumns(
            {
                "channel": F.col("marketing_channel"),
                "date": F.coalesce(F.col("kinesis_arrival_timestamp").cast("timestamp").cast("date").cast("string"), F.lit("unknown")),
                "batch": F.lit(batch_id),
            }
        )
        (
            out.hint("rebalance", "channel", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("channel", "date", "batch")
            .json(bronze_dir)
        )
        bad = tagged.filter(F.col("error").isNotNull()).drop("_msg").withColumn("batch", F.lit(batch_id))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").json(dead_letter_dir)
    finally:
        tagged.unpersist()


def compact_bronze(spark: SparkSession, bronze_dir: str, date: str, remove: bool = True) -> int:
    """S14 upkeep: rewrites a past day's (or each day's that matches a pattern) micro-batch folders
    as one folder for each channel, its lines unchanged, the day's next generation (``batch=upto-<n>``: all rows of
    batches up to n), in one job, then removes the folders they replace. Returns the number of
    folders removed. A generation counts once it has its ``_SUCCESS``, and
    ``readers.read_bronze_bookings`` reads the highest that counts and the batches behind it: a job
    that dies anywhere leaves every row readable exactly once, and the next run finishes its work.
    Without ``remove`` what is replaced stays for a later run."""
    fs, root = tables._fs_path(spark, bronze_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    plain = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    done = readers.complete_generations(spark, bronze_dir)
    days: dict[tuple[str, str, str], list[str]] = {}
    for st in fs.globStatus(path(root, f"channel=*/date={date}/batch=*")) or []:
        day, _, name = st.getPath().toString().rpartition("/batch=")
        channel, on = (plain(part.split("=", 1)[1]) for part in day.split("/")[-2:])
        days.setdefault((channel, on, day), []).append(name)
    number = lambda name: int(name.removeprefix(readers.GENERATION))
    parts, targets, stale = [], [], []
    for (channel, on, day), names in days.items():
        upto = done.get((channel, on))
        fresh = [n for n in names if not n.startswith(readers.GENERATION) and (upto is None or int(n) > upto)]
        if fresh:
            kept = fresh + ([f"{readers.GENERATION}{upto}"] if upto is not None else [])
            parts += [f"{day}/batch={n}" for n in kept]
            upto = max(map(number, fresh))
            targets.append((channel, on, f"{readers.GENERATION}{upto}", day))
        stale += [f"{day}/batch={n}" for n in names if upto is not None and n != f"{readers.GENERATION}{upto}"]
    if targets:
        # lines are copied as they are: not parsed, and none that a reader of today does not know is lost
        fields = [T.StructField(n, T.StringType()) for n in ("value", "channel", "date", "batch")]
        rows = spark.read.schema(T.StructType(fields)).option("basePath", bronze_dir).text(parts).drop("batch")
        names = spark.createDataFrame([t[:3] for t in targets], "channel string, date string, batch string")
        (
            rows.join(names, ["channel", "date"]).hint("rebalance", "channel", "date", "batch")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("channel", "date", "batch").text(bronze_dir)
        )
        for _, _, name, day in targets:
            fs.create(path(f"{day}/batch={name}/_SUCCESS"), True).close()
    for folder in stale if remove else ():
        fs.delete(path(folder), True)
    return len(stale) if remove else 0


def _skip_backlog(env: DataFrame, checkpoint: str) -> None:
    """T5: at the first start, enters the files there are into the stream's log without reading
    them: a run to the end of the same query behind a condition on the files' own times that no
    file meets, so that its scan lists no file."""
    spark = env.sparkSession
    marker = f"{checkpoint.rstrip('/')}_latest"
    if not tables.path_exists(spark, marker):
        none = F.col("_metadata.file_modification_time") < F.lit("1900-01-01").cast("timestamp")
        run_to_end(_decoded(env.where(none), checkpoint, lambda df, batch_id: df.foreach(lambda row: None), {"availableNow": True}))
        fs, p = tables._fs_path(spark, marker)
        fs.mkdirs(p)


def bronze_writer(
    spark: SparkSession,
    envelopes_dir: str,
    bronze_dir: str,
    dead_letter_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files_per_trigger: int = 100,
    start: str = "earliest",
) -> StreamingQuery:
    """T2 (+T3, T4, T5): booking envelopes -> bronze JSON. A micro-batch replayed after a
    failure rewrites its own batch folders (exactly-once output; the dedup uses the batch's
    recorded timestamp, so a replay sees the same rows). Upstream redeliveries carry the same
    sequence number and are dropped by T4; the event id derived from it is deterministic, and
    the silver upsert on invitee_uri is idempotent. ``start`` is "earliest" (every file there
    is) or "latest" (files that come after the stream's first start; the others are listed, not
    read, T5)."""
    if start == "latest":
        _skip_backlog(readers.read_booking_stream(spark, envelopes_dir, None), checkpoint)
    env = readers.read_booking_stream(spark, envelopes_dir, max_files_per_trigger)
    return start_bronze_writer(env, bronze_dir, dead_letter_dir, checkpoint, trigger)


def start_bronze_writer(
    envelopes: DataFrame,
    bronze_dir: str,
    dead_letter_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """T2 over any streaming source with the envelope columns ``data, sequence_number,
    partition_key, arrival_ts`` (for example a Kafka or Kinesis stream where the connector is
    installed: ``value`` cast to string as ``data``, ``offset``/``sequenceNumber`` as
    ``sequence_number``, ``key`` as ``partition_key``, ``timestamp`` as ``arrival_ts``)."""
    return _decoded(envelopes, checkpoint, lambda df, batch_id: write_bronze_batch(df, bronze_dir, dead_letter_dir, batch_id), trigger)


def _decoded(envelopes: DataFrame, checkpoint: str, write, trigger: dict | None) -> StreamingQuery:
    """The stream of T2: redeliveries dropped, envelopes decoded, each batch given to ``write``."""
    # Processed and failed counts of every micro-batch, reported in the query's
    # progress (``observedMetrics["bronze_batch"]``) without a second job.
    tagged = tag_decode_errors(dedup_redeliveries(envelopes)).observe(
        "bronze_batch",
        F.count(F.when(F.col("error").isNull(), F.lit(1))).alias("processed"),
        F.count(F.when(F.col("error").isNotNull(), F.lit(1))).alias("failed"),
    )
    return _start(tagged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger)


# ---------------------------------------------------------------- T6, S23
def bronze_to_silver_incremental(
    spark: SparkSession,
    bronze_dir: str,
    silver_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    multiline: bool = False,
) -> StreamingQuery:
    """Only new bronze files are processed (the stream's checkpoint is the bookmark);
    each micro-batch is cleaned (X1) and upserted (S6): the newest version of a booking stays,
    whichever file brings it first, as in a full rescan."""
    from slotflow.operators.windows import latest_first
    from slotflow.plans.batch_jobs import BOOKING_TIE_BREAKS

    bronze = (
        spark.readStream.schema(schemas.BRONZE_BOOKING)
        .option("recursiveFileLookup", "true")
        .option("multiLine", multiline)
        .json(bronze_dir)
    )

    def upsert(batch: DataFrame, _id: int) -> None:
        if batch.isEmpty():
            return
        tables.upsert_table(
            spark, silver_path, clean_bookings(batch), ["invitee_uri"], tables.BOOKING_PARTITIONS,
            latest_first("webhook_received_at", BOOKING_TIE_BREAKS),
        )

    return _start(bronze.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert), trigger or {"availableNow": True})


def spend_to_silver_incremental(
    spark: SparkSession,
    bronze_dir: str,
    silver_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    multiline: bool = True,
) -> StreamingQuery:
    """T6 for spend: new bronze spend documents -> X2 -> upsert on (date, channel)."""
    from slotflow.plans.batch_jobs import spend_versions
    from slotflow.plans.normalize import clean_spend

    bronze = (
        spark.readStream.schema(schemas.BRONZE_SPEND)
        .option("recursiveFileLookup", "true")
        .option("multiLine", multiline)
        .json(bronze_dir)
    )

    def upsert(batch: DataFrame, _id: int) -> None:
        if batch.isEmpty():
            return
        tables.upsert_table(
            spark, silver_path, clean_spend(readers.spend_records(batch)), ["date", "channel"], tables.SPEND_PARTITIONS,
            spend_versions(), partitions_follow_keys=True,
        )

    return _start(bronze.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert), trigger or {"availableNow": True})


# ---------------------------------------------------------------- T7
def booking_ids(bronze: DataFrame) -> DataFrame:
    """(date, channel, id) of bronze records with an appointment and an id."""
    day = F.col("scheduled_event_start_time").try_cast("timestamp").cast("date")
    ids = bronze.select(day.alias("date"), F.col("marketing_channel").alias("channel"), F.coalesce("event_id", "invitee_uri").alias("id"))
    return ids.where("date IS NOT NULL AND channel IS NOT NULL AND id IS NOT NULL")


def count_batch(spark: SparkSession, new_ids: DataFrame, batch_id: int, counts_path: str) -> None:
    """One micro-batch of T7: adds its bookings, each one new to the stream's state, to their cells
    (day, channel). A cell keeps its last batch and its count before that, so that a batch that
    runs again (same offsets and state, so the same rows) starts from the same count."""
    added = stage(new_ids.groupBy("date", "channel").agg(F.count("*").alias("added")), "live-added")
    years = [r["year"] for r in added.select(F.year("date").alias("year")).distinct().collect()]  # calendar years
    if years:
        cell = {"date": "date", "channel": "string", "total_bookings": "bigint", "before": "bigint", "batch": "bigint", "year": "int"}
        base = F.when(F.col("batch") == batch_id, F.col("before")).otherwise(F.col("total_bookings"))
        old = readers.read_silver(spark, counts_path, cell).where(F.col("year").isin(years)).select("date", "channel", base.alias("base"))
        before = F.coalesce("base", F.lit(0).cast("long"))
        counts = added.join(old, ["date", "channel"], "left").select(
            "date", "channel", (before + F.col("added")).alias("total_bookings"), before.alias("before"),
            F.lit(batch_id).cast("long").alias("batch"), F.year("date").alias("year"))
        tables.upsert_table(spark, counts_path, counts, ["date", "channel"], ["year"], partitions_follow_keys=True)
    drop_staged(added)


def live_daily_counts(
    spark: SparkSession,
    bronze_dir: str,
    counts_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Bookings per (day, channel) over a stream of bronze records, in a keyed table that
    always equals the batch count (A3) of what has arrived. The bookings counted are the stream's
    keyed state (RocksDB, partitioned by key, a fixed number of versions kept), the table has a
    folder a year that each batch rewrites: the number of files does not grow with the batches.
    There is no watermark: appointments lie in any order and any distance ahead. The table belongs
    to the checkpoint; a new checkpoint needs a new table."""
    bronze = (
        spark.readStream.schema(schemas.BRONZE_BOOKING)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", readers.NO_AGE_LIMIT)
        .json(bronze_dir)
    )
    new_ids = booking_ids(bronze).dropDuplicates(["date", "channel", "id"])
    return _start(
        new_ids.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda df, batch_id: count_batch(spark, df, batch_id, counts_path)
        ),
        trigger,
    )


def run_to_end(queries: StreamingQuery | list[StreamingQuery]) -> None:
    """Wait for availableNow queries to finish (tests, backfills) and surface failures."""
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
