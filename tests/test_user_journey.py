"""The whole flow through the public API, as a deployment runs it: spend files -> ingestion;
webhook requests -> intake stream -> bronze stream; bronze -> silver (incremental); silver ->
gold; a dashboard read model over the catalog tables. Counts must reconcile end to end."""

import json
import os

from pyspark.sql import functions as F

import slotflow
from slotflow.plans.readmodels import read_model
from slotflow.sources import adapters as AD
from slotflow.streaming import jobs as J
from conftest import SF_SMALL


def test_end_to_end_through_the_public_api(spark, tmp_dir):
    cfg = slotflow.PipelineConfig(f"{tmp_dir}/bronze", f"{tmp_dir}/silver", f"{tmp_dir}/gold", "journey",
                                  AD.FIXTURE_EVENT_TYPE_CHANNELS)
    # spend source: daily files named spend_data_<date>.json (bare JSON arrays)
    src = f"{tmp_dir}/spend_src"
    os.makedirs(src)
    for day in ["2024-01-10", "2024-01-11"]:
        with open(f"{src}/spend_data_{day}.json", "w") as f:
            json.dump([{"channel": ch, "date": day, "spend": 10.0 + i} for i, ch in enumerate(["search_ads", "social_ads", "video_ads"])], f)
    ingested = slotflow.ingest_spend(spark, src, cfg, as_of="2024-01-12")
    assert ingested["records_processed"] == 6

    # webhook requests -> intake stream -> keyed messages
    reqs = AD.events_requests(spark, SF_SMALL).select("body")
    reqs.write.text(f"{tmp_dir}/requests")
    J.run_to_end(slotflow.webhook_intake(spark, f"{tmp_dir}/requests", f"{tmp_dir}/messages", f"{tmp_dir}/archive",
                                         f"{tmp_dir}/ckpt/intake", cfg.event_type_channels, trigger={"availableNow": True}))
    messages = spark.read.schema("key string, value string").json(f"{tmp_dir}/messages")
    # the broker wraps each message: base64 payload, a sequence number, the key, an arrival time
    envelopes = messages.select(
        F.base64(F.col("value").cast("binary")).alias("data"),
        F.sha2(F.col("value"), 256).alias("sequence_number"),
        F.col("key").alias("partition_key"),
        F.lit(1.7e9).alias("arrival_ts"),
    )
    envelopes.write.json(f"{tmp_dir}/envelopes")
    J.run_to_end(slotflow.bronze_writer(spark, f"{tmp_dir}/envelopes", cfg.bronze_bookings, f"{tmp_dir}/dead",
                                        f"{tmp_dir}/ckpt/bronze", trigger={"availableNow": True}))

    slotflow.bronze_to_silver_incremental(spark, cfg, multiline=False)
    silver = spark.table("journey.bookings_silver")
    n_tracked = messages.count()
    assert silver.count() == n_tracked > 0  # every tracked webhook reaches silver once
    assert spark.table("journey.marketing_spend_silver").count() == 6

    errors = []
    counts = slotflow.silver_to_gold(spark, cfg, errors=errors)
    assert not errors and all(counts[m] > 0 for m in ["daily_bookings_by_source", "cost_per_booking", "channel_attribution"])
    daily_total = spark.table("journey.daily_bookings_by_source").agg(F.sum("total_bookings")).first()[0]
    assert daily_total == n_tracked
    # a dashboard read model over the catalog's gold table
    view = read_model(spark, "v_channel_attribution", database="journey").collect()
    assert {r["channel"] for r in view} == {"search_ads", "social_ads", "video_ads"}
    assert sum(r["total_bookings"] for r in view) == n_tracked
    assert abs(sum(r["total_spend"] for r in view) - 66.0) < 1e-9  # two days of 10 + 11 + 12
