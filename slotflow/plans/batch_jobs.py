"""End-to-end batch jobs."""

from __future__ import annotations

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from slotflow import schemas
from slotflow.config import PipelineConfig
from slotflow.operators import aggregations as A
from slotflow.operators.ordering import ROWS_A_SPLIT, latest_sources, splits_for
from slotflow.operators.projections import with_ingest_metadata
from slotflow.operators.windows import latest_first
from slotflow.plans.metrics import GOLD_METRICS
from slotflow.plans.normalize import SPEND_TIE_BREAKS, clean_bookings, clean_spend
from slotflow.session import configure
from slotflow.sources import files, readers, tables
from slotflow.sources.bookmarks import Bookmark
from slotflow.sources.staging import drop_staged, stage

log = logging.getLogger(__name__)

# Q5: bookings are deduplicated latest-first (by webhook_received_at) before the upsert; these
# columns then break ties, so the winner is deterministic.
BOOKING_TIE_BREAKS = [
    "invitee_updated_at", "invitee_created_at", "scheduled_event_start_time", "scheduled_event_status",
    "invitee_status", "marketing_channel", "invitee_email",
]
# Columns the gold metrics read from silver (column pruning at the scan).
GOLD_BOOKING_COLUMNS = {
    "invitee_uri": "string", "invitee_email": "string", "marketing_channel": "string", "event_status": "string",
    "invitee_canceled": "boolean", "booking_date": "date", "booking_day_of_week": "int", "booking_hour": "int",
    "host_email": "string", "host_name": "string", "scheduled_event_start_time": "timestamp",
}
GOLD_SPEND_COLUMNS = {"date": "date", "channel": "string", "spend": "double"}


def spend_versions() -> list[Column]:
    """Newest ingestion wins, among old and new spend of a (date, channel)."""
    return latest_first("ingested_at", SPEND_TIE_BREAKS)


def with_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row counter filled in by the action that writes ``df`` (no second job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def with_corrupt(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counter of the documents of a bronze scan that did not parse."""
    obs = Observation(name)
    return df.observe(obs, F.count(schemas.CORRUPT).alias("corrupt")), obs


def bronze_to_silver(spark: SparkSession, cfg: PipelineConfig, multiline: bool = True, bookmark: bool = False) -> dict[str, int]:
    """Bronze JSON -> clean (X1, X2) -> keyed upserts into partitioned silver tables
    (S4-S9) -> catalog registration (S11). ``multiline``: one pretty-printed object per file
    (the webhook writer's layout) or JSON lines (the streaming writer's). With ``bookmark`` only
    dates whose folders changed since the last run are read (S23); the bookmark is kept after the
    upserts, so a run that dies is repeated. Returns the rows of either table, the number of
    documents that did not parse and, with ``bookmark``, of booking dates read (-1: all)."""
    configure(spark)
    marks = [Bookmark(spark, cfg.bookmarks, n, p) for n, p in (("bookings", cfg.bronze_bookings), ("spend", cfg.bronze_spend))] if bookmark else []
    booking_dates, spend_dates = (m.dates for m in marks) if marks else (None, None)
    b = s = c = d = 0
    if booking_dates != []:
        read, bad = with_corrupt(readers.read_bronze_bookings(spark, cfg.bronze_bookings, multiline, booking_dates), "bad_bookings")
        b = tables.upsert_table(
            spark, cfg.silver_bookings, clean_bookings(read), ["invitee_uri"], tables.BOOKING_PARTITIONS,
            latest_first("webhook_received_at", BOOKING_TIE_BREAKS),
        )["rows"]
        c = int(bad.get["corrupt"])
    if spend_dates != []:
        read, bad = with_corrupt(readers.read_bronze_spend(spark, cfg.bronze_spend, multiline, spend_dates), "bad_spend")
        s = tables.upsert_table(
            spark, cfg.silver_spend, clean_spend(read), ["date", "channel"], tables.SPEND_PARTITIONS, spend_versions(), partitions_follow_keys=True
        )["rows"]
        d = int(bad.get["corrupt"])
    for mark in marks:
        mark.keep()
    for name, path in (("bookings_silver", cfg.silver_bookings), ("marketing_spend_silver", cfg.silver_spend)):
        if tables.table_exists(spark, path):
            tables.register_table(spark, cfg.database, name, path)
    counts = {"bookings": b, "spend": s, "unreadable": c + d}
    return counts | {"dates": -1 if booking_dates is None else len(booking_dates)} if bookmark else counts


def bronze_to_silver_incremental(spark: SparkSession, cfg: PipelineConfig, multiline: bool = True) -> None:
    """X3 on new bronze files only (decision Q14): both silver tables are fed by
    ``availableNow`` file streams whose checkpoints (next to the silver tables) are the
    bookmark; each micro-batch is cleaned and upserted, so a rerun after a failure is safe."""
    from slotflow.streaming import jobs

    configure(spark)
    ckpt = f"{cfg.silver_root.rstrip('/')}/_checkpoints"
    jobs.run_to_end(
        [
            jobs.bronze_to_silver_incremental(spark, cfg.bronze_bookings, cfg.silver_bookings, f"{ckpt}/bookings", multiline=multiline),
            jobs.spend_to_silver_incremental(spark, cfg.bronze_spend, cfg.silver_spend, f"{ckpt}/spend", multiline=multiline),
        ]
    )
    tables.register_table(spark, cfg.database, "bookings_silver", cfg.silver_bookings)
    tables.register_table(spark, cfg.database, "marketing_spend_silver", cfg.silver_spend)


def silver_to_gold(
    spark: SparkSession, cfg: PipelineConfig, metrics: list[str] | None = None, errors: list[str] | None = None
) -> dict[str, int]:
    """The gold metrics, each a pruned scan of silver reduced before its shuffle; nothing is
    kept in executors' caches. The metrics are submitted together, so Spark runs them side by
    side. A metric that fails is logged and recorded as 0 rows; the others still run. Silver
    tables without rows, or not there yet, give metrics without rows."""
    configure(spark)

    def build(name: str) -> tuple[str, int, str | None]:
        try:
            bookings = readers.read_silver(spark, cfg.silver_bookings, GOLD_BOOKING_COLUMNS)
            spend = readers.read_silver(spark, cfg.silver_spend, GOLD_SPEND_COLUMNS)
            df, obs = with_metrics(GOLD_METRICS[name](bookings, spend), name)
            path = tables.write_gold(df, cfg.gold_metrics, name)
            tables.register_table(spark, cfg.database, name, path)
            return name, int(obs.get["rows"]), None
        except Exception as e:  # noqa: BLE001 - one metric must not stop the others
            log.error("metric %s failed: %s", name, e)
            return name, 0, f"{name}: {e}"

    names = metrics or list(GOLD_METRICS)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{cfg.database}`")  # once, before the concurrent registrations
    out: dict[str, int] = {}
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        for name, rows, error in pool.map(build, names):
            out[name] = rows
            if error and errors is not None:
                errors.append(error)
    return out


def ingest_spend(
    spark: SparkSession,
    source_dir: str,
    cfg: PipelineConfig,
    as_of: str | None = None,
    lookback_days: int = 30,
    execution_date: str | None = None,
) -> dict[str, object]:
    """X11: pick the newest ``lookback_days`` spend files named by the source's index file
    (else by a listing of the folder; O4, with the date fallback O5), read them in one scan
    (S17), stamp ingest metadata (P17), nest per (date, channel) and file (A17), write bronze
    documents (S18) with every field of the source, and record the run (S20). Files and records
    that do not parse (S19) go to the dead-letter table of the execution date and are counted.
    ``execution_date`` (for a backfill) defaults to the day before ``as_of`` (F11). A run can be
    repeated: it rewrites its own documents."""
    configure(spark)
    today = dt.date.fromisoformat(as_of) if as_of else dt.datetime.now(dt.timezone.utc).date()
    execution_date = execution_date or (today - dt.timedelta(days=1)).isoformat()
    try:
        index = f"{source_dir.rstrip('/')}/{files.INDEX_FILE}"
        if tables.path_exists(spark, index):
            listed = files.source_dates(files.read_file_index(spark, index))
        else:
            listed = files.list_source_dates(spark, source_dir)
        # k newest dates only: a bounded list (lookback_days values) on the driver.
        dates = [r["file_date"].isoformat() for r in latest_sources(listed, lookback_days).collect() if r["file_date"]]
        if not dates:
            dates = readers.lookback_dates(execution_date, lookback_days)
        rows = stage(readers.read_spend_files(spark, source_dir, dates), "spend-source")
        counts = rows.agg(F.count_if(F.col("error").isNull()).alias("good"), F.count("error").alias("bad")).first()
        stamped = with_ingest_metadata(readers.spend_fields(rows), F.col("source_file"))
        added = {
            "ingested_at": F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "source_file": F.col("source_file"),
            "ingestion_date": F.lit(execution_date),
        }
        own = F.map_filter("fields", lambda k, _: ~k.isin(list(added)))
        stamps = F.create_map(*[x for k, v in added.items() for x in (F.lit(k), v.cast("variant"))])
        if counts["good"]:
            # the records of a part of a file meet in one task; a task gets a bounded number of them
            stamped = stamped.repartition(splits_for(rows, counts["good"], ROWS_A_SPLIT), "source_file", "part")
            nested = A.nest_spend(stamped, F.map_concat(own, stamps))
            tables.write_bronze_spend(nested, cfg.bronze_spend, execution_date)
        tables.replace_partition(
            spark, rows.where("error IS NOT NULL").drop("fields", "part"), cfg.spend_dead_letters, "execution_date", execution_date, "json"
        )
        drop_staged(rows)
        tables.record_run(spark, cfg.run_log, "spend_ingestion", execution_date, counts["good"], len(dates))
        return {
            "execution_date": execution_date, "records_processed": counts["good"], "records_failed": counts["bad"],
            "files_processed": len(dates),
        }
    except Exception as e:
        tables.record_run(spark, cfg.run_log, "spend_ingestion", execution_date, 0, 0, "failed", str(e))
        raise
