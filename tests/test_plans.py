"""Plan shape: pruning and pushdown reach the scan, no cartesian products, dedup is a
partial top-1 before the shuffle, CPB reuses the aggregate partitioning."""

import pytest

from conftest import SF_SMALL
from slotflow.plans.registry import QUERIES
from slotflow.operators.windows import dedup_latest, latest_first
from slotflow.sources import adapters as AD


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# queries that run jobs or streams over files while they are built: their plans are reads of files
JOBS = ("bronze_to_silver", "silver_to_gold", "ingest_spend", "spend_dead", "stream_", "webhook_archive", "upsert_bookings_table", "upsert_spend_table",
        "message_order", "bronze_bookmark", "batch_counters", "discovered_tables", "compacted_bronze")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(JOBS) or n == "stream_messages"))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_is_pruned_and_filter_pushed(spark):
    df = QUERIES["daily_bookings_by_source"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    one = QUERIES["attribute_channel_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type)]" in one
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


@pytest.mark.parametrize("name", ["flatten_booking", "clean_bookings_nested", "dead_letters", "meeting_load_nested", "batch_outcome"])
def test_json_is_parsed_once_per_row(spark, name):
    """The webhook's text and the message's text: one parse each, however many fields are read."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2, plan.count("from_json(")
    assert len(plan) < 100_000


def test_spend_records_do_not_carry_their_file(spark, tmp_path):
    """Above the splitter nothing is as large as a file: the generator of the elements carries no
    text or array along (those over an array of one, which keep a parse from being copied, carry
    their own record)."""
    from slotflow.sources import readers

    (tmp_path / "spend_data_2024-01-01.json").write_text('[{"a": 1}]')
    rows = readers.read_spend_files(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    elements = [line for line in plan.splitlines() if "Generate explode(" in line and "Generate explode(array(" not in line]
    assert elements
    for line in elements:
        carried = line.rsplit(", [", 2)[1].split("]")[0]
        assert not {c.split("#")[0].strip() for c in carried.split(",")} & {"text", "read", "parts", "value"}, line
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2  # the array's text, the record's fields


def test_dedup_has_partial_group_limit(spark):
    li = AD.read_table(spark, SF_SMALL, "lineitem")
    df = dedup_latest(li, ["l_orderkey", "l_linenumber"], latest_first("l_shipdate", ["l_partkey"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_cost_per_booking_exchanges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["cost_per_booking"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two aggregates on (date, channel) feed the full outer join without re-shuffling it
    assert "SortMergeJoin" in plan and "FullOuter" in plan


@pytest.mark.parametrize("name", ["daily_bookings_by_source", "cost_per_booking", "channel_attribution",
                                  "booking_time_analysis", "employee_meeting_load", "bookings_trend", "clean_spend"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    """A hot key (a third of all rows) must be reduced map-side: every aggregation has a
    partial stage (or, for the dedup, a partial group limit) below its exchange."""
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "partial_" in plan or "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_last_n_days_prunes_silver_partitions(spark, tmp_path):
    """P21 on a silver table partitioned by year/month: the scan reads the covered months only."""
    import datetime as dt

    from pyspark.sql import functions as F

    from slotflow.operators.projections import last_n_days
    from slotflow.sources import tables

    days = [(f"u{i}", dt.date(2023, 11, 1) + dt.timedelta(days=i), "fb") for i in range(120)]
    df = spark.createDataFrame(days, "invitee_uri string, booking_date date, marketing_channel string")
    df = df.withColumns({"booking_year": F.year("booking_date"), "booking_month": F.month("booking_date")})
    path = str(tmp_path / "silver")
    tables.write_silver_bookings(df, path)
    recent = last_n_days(spark.read.parquet(path), "booking_date", 7, "2024-01-03")
    assert sorted(r["booking_date"].isoformat() for r in recent.collect()) == [
        "2023-12-28", "2023-12-29", "2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03"]
    plan = _plan(recent)
    assert "PartitionFilters: [" in plan and "booking_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
