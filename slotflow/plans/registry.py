"""The query registry behind ``__spark_entry__``: one entry per implemented operator of the
survey's inventory, each a function (spark, sf_dir) -> DataFrame over whole tables, plus the
matching DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slotflow import schemas as SC
from slotflow.operators import aggregations as A
from slotflow.operators import ordering as O
from slotflow.operators.projections import coerce, last_n_days, sanitize_columns, tag_decode_errors
from slotflow.operators.upsert import merge_upsert
from slotflow.operators.windows import dedup_latest, latest_first
from slotflow.plans import metrics as M
from slotflow.plans import oracle as Q
from slotflow.plans import readmodels as R
from slotflow.plans import webhooks as WH
from slotflow.plans.normalize import clean_bookings
from slotflow.session import configure, scratch_path
from slotflow.sources import adapters as AD
from slotflow.sources import files as FL

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


# Silver inputs built from the adapters (X1 applied to the bronze-shaped rows).
def silver_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_bookings(AD.events_bookings(spark, sf_dir))


def silver_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_bookings(AD.orders_bookings(spark, sf_dir))


def meetings_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_bookings(AD.lineitem_meetings(spark, sf_dir))


# ------------------------------------------------------------------ gold metrics X4-X9
@register("daily_bookings_by_source", Q.with_ctes(Q.E_BOOKINGS) + Q.daily_bookings_sql("e_bookings"))
def q_daily_bookings_by_source(spark, sf_dir):
    """X4 / A1 / A2 on adapter E."""
    return M.daily_bookings_by_source(silver_e(spark, sf_dir), clock=False)


@register("cost_per_booking", Q.with_ctes(Q.O_BOOKINGS, Q.O_SPEND) + Q.cost_per_booking_sql("o_bookings", "o_spend"))
def q_cost_per_booking(spark, sf_dir):
    """X5 / A3 / A4 / J1 / W1-W3 / F12 / F14 on adapter O."""
    return M.cost_per_booking(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)


@register("bookings_trend", Q.with_ctes(Q.E_BOOKINGS) + Q.bookings_trend_sql("e_bookings"))
def q_bookings_trend(spark, sf_dir):
    """X6 / A5 / W4 / W5 / F9 on adapter E."""
    return M.bookings_trend(silver_e(spark, sf_dir), clock=False)


@register("channel_attribution", Q.with_ctes(Q.O_BOOKINGS, Q.O_SPEND) + Q.channel_attribution_sql("o_bookings", "o_spend"))
def q_channel_attribution(spark, sf_dir):
    """X7 / A6 / A7 / J2 / W6 / W7 on adapter O."""
    return M.channel_attribution(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)


@register("booking_time_analysis", Q.with_ctes(Q.E_BOOKINGS) + Q.booking_time_sql("e_bookings"))
def q_booking_time_analysis(spark, sf_dir):
    """X8 / A8 / W8 / F13 on adapter E."""
    return M.booking_time_analysis(silver_e(spark, sf_dir), clock=False)


@register("employee_meeting_load", Q.with_ctes(Q.O_MEETINGS) + Q.meeting_load_sql("o_meetings"))
def q_employee_meeting_load(spark, sf_dir):
    """X9 / A9 on adapter O (lineitem x supplier)."""
    return M.employee_meeting_load(meetings_o(spark, sf_dir), clock=False)


def _full(sql_body: str, *ctes: str) -> str:
    return Q.with_ctes(*ctes) + sql_body


def _wrap(inner: str, outer: str) -> str:
    """``outer`` selects from ``gold`` = the result of the full statement ``inner``."""
    return outer.replace("{gold}", f"({inner}) AS gold")


DAILY_E = _full(Q.daily_bookings_sql("e_bookings"), Q.E_BOOKINGS)
CPB_O = _full(Q.cost_per_booking_sql("o_bookings", "o_spend"), Q.O_BOOKINGS, Q.O_SPEND)
ATTR_O = _full(Q.channel_attribution_sql("o_bookings", "o_spend"), Q.O_BOOKINGS, Q.O_SPEND)
TIME_E = _full(Q.booking_time_sql("e_bookings"), Q.E_BOOKINGS)
LOAD_O = _full(Q.meeting_load_sql("o_meetings"), Q.O_MEETINGS)


# ------------------------------------------------------------------ read models, roll-ups


_GOLD_FOR_VIEWS = {
    "daily_bookings_by_source": lambda spark, sf_dir: M.daily_bookings_by_source(silver_e(spark, sf_dir), clock=False),
    "cost_per_booking": lambda spark, sf_dir: M.cost_per_booking(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False),
    "channel_attribution": lambda spark, sf_dir: M.channel_attribution(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False),
    "booking_time_analysis": lambda spark, sf_dir: M.booking_time_analysis(silver_e(spark, sf_dir), clock=False),
    "employee_meeting_load": lambda spark, sf_dir: M.employee_meeting_load(meetings_o(spark, sf_dir), clock=False),
}


def _gold_views(spark, sf_dir, *names):
    """Expose the named gold tables as temp views (each view is a lazy plan)."""
    R.register_gold_views({n: _GOLD_FOR_VIEWS[n](spark, sf_dir) for n in names})


@register("v_daily_bookings", _wrap(DAILY_E, "SELECT booking_date AS date, source, total_bookings, active_bookings, cancelled_bookings, cancellation_rate FROM {gold}"))
def q_v_daily_bookings(spark, sf_dir):
    """Dashboard read model over gold, through spark.sql on temp views."""
    _gold_views(spark, sf_dir, "daily_bookings_by_source")
    return R.read_model(spark, "v_daily_bookings")


@register("v_cost_per_booking", _wrap(CPB_O, "SELECT date, channel, total_spend, total_bookings, cost_per_booking, cumulative_spend, cumulative_bookings, cumulative_cpb FROM {gold}"))
def q_v_cost_per_booking(spark, sf_dir):
    """P19 / S22 / O1."""
    _gold_views(spark, sf_dir, "cost_per_booking")
    return R.read_model(spark, "v_cost_per_booking")


@register("v_channel_attribution", _wrap(ATTR_O, "SELECT channel, total_bookings, unique_leads, total_spend, cost_per_booking, cost_per_lead, rank_by_bookings, rank_by_cpb FROM {gold}"))
def q_v_channel_attribution(spark, sf_dir):
    """P19 / S22 / O2."""
    _gold_views(spark, sf_dir, "channel_attribution")
    return R.read_model(spark, "v_channel_attribution")


@register("v_booking_time", _wrap(TIME_E, "SELECT booking_hour, booking_day_of_week, marketing_channel, bookings_count, percentage_of_channel FROM {gold}"))
def q_v_booking_time(spark, sf_dir):
    """P19 / S22."""
    _gold_views(spark, sf_dir, "booking_time_analysis")
    return R.read_model(spark, "v_booking_time")


@register("v_meeting_load", _wrap(LOAD_O, "SELECT host_email, host_name, avg_meetings_per_week, total_meetings, weeks_active, max_meetings_in_week, min_meetings_in_week FROM {gold}"))
def q_v_meeting_load(spark, sf_dir):
    """P19 / S22 / O2."""
    _gold_views(spark, sf_dir, "employee_meeting_load")
    return R.read_model(spark, "v_meeting_load")


@register("weekly_trend", _full("""
, d AS (SELECT booking_date AS date, marketing_channel AS source, count(invitee_uri) AS bookings_count FROM e_bookings GROUP BY ALL)
SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, source, CAST(sum(bookings_count) AS BIGINT) AS bookings_count,
       count(*) AS days_with_bookings FROM d GROUP BY ALL""", Q.E_BOOKINGS))
def q_weekly_trend(spark, sf_dir):
    """A10: weekly volume by source."""
    return M.weekly_bookings_trend(silver_e(spark, sf_dir))


@register("kpi_summary", _wrap(ATTR_O, """
SELECT CAST(sum(total_bookings) AS BIGINT) AS total_bookings,
       CAST(sum(CAST(total_spend AS DECIMAL(38,6))) AS DOUBLE) AS total_spend,
       round(avg(cost_per_booking), 6) AS avg_cost_per_booking,
       CAST(sum(unique_leads) AS BIGINT) AS unique_leads
FROM {gold}"""))
def q_kpi_summary(spark, sf_dir):
    """A11 over the channel attribution table."""
    attr = M.channel_attribution(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)
    return R.kpi_summary(attr)


KPI_AS_OF, KPI_DAYS = "2024-01-30", 7


@register("kpi_period_delta", _full(f"""
, p AS (SELECT DATE '{KPI_AS_OF}' AS e)
, b AS (SELECT CASE WHEN booking_date > e - {KPI_DAYS} AND booking_date <= e THEN 'current'
                    WHEN booking_date > e - {2 * KPI_DAYS} AND booking_date <= e - {KPI_DAYS} THEN 'previous' END AS per,
               invitee_uri, invitee_email FROM e_bookings, p)
, s AS (SELECT CASE WHEN date > e - {KPI_DAYS} AND date <= e THEN 'current'
                    WHEN date > e - {2 * KPI_DAYS} AND date <= e - {KPI_DAYS} THEN 'previous' END AS per,
               spend FROM e_spend, p)
, k AS (SELECT
   (SELECT count(invitee_uri) FROM b WHERE per = 'current') AS bookings_current,
   (SELECT count(invitee_uri) FROM b WHERE per = 'previous') AS bookings_previous,
   (SELECT CAST(coalesce(sum(CAST(spend AS DECIMAL(38,6))), 0) AS DOUBLE) FROM s WHERE per = 'current') AS spend_current,
   (SELECT CAST(coalesce(sum(CAST(spend AS DECIMAL(38,6))), 0) AS DOUBLE) FROM s WHERE per = 'previous') AS spend_previous,
   (SELECT count(DISTINCT invitee_email) FROM b WHERE per = 'current') AS leads_current,
   (SELECT count(DISTINCT invitee_email) FROM b WHERE per = 'previous') AS leads_previous)
, c AS (SELECT *, CASE WHEN bookings_current > 0 THEN spend_current / bookings_current END AS cpb_current,
                  CASE WHEN bookings_previous > 0 THEN spend_previous / bookings_previous END AS cpb_previous FROM k)
SELECT *,
  CASE WHEN bookings_previous > 0 THEN CAST(bookings_current - bookings_previous AS DOUBLE) / bookings_previous * 100 END AS bookings_change_pct,
  CASE WHEN spend_previous > 0 THEN (spend_current - spend_previous) / spend_previous * 100 END AS spend_change_pct,
  CASE WHEN cpb_previous > 0 THEN (cpb_current - cpb_previous) / cpb_previous * 100 END AS cpb_change_pct,
  CASE WHEN leads_previous > 0 THEN CAST(leads_current - leads_previous AS DOUBLE) / leads_previous * 100 END AS leads_change_pct
FROM c""", Q.E_BOOKINGS, Q.E_SPEND))
def q_kpi_period_delta(spark, sf_dir):
    """Last 7 days to 2024-01-30 against the 7 days before (events adapter)."""
    return R.kpi_period_delta(silver_e(spark, sf_dir), AD.events_spend(spark, sf_dir), KPI_AS_OF, KPI_DAYS)


@register("overall_cpb", _wrap(CPB_O, """
SELECT channel, CAST(sum(CAST(total_spend AS DECIMAL(38,6))) AS DOUBLE) AS total_spend, CAST(sum(total_bookings) AS BIGINT) AS total_bookings,
  CASE WHEN sum(total_bookings) > 0 THEN CAST(sum(CAST(total_spend AS DECIMAL(38,6))) AS DOUBLE) / CAST(sum(total_bookings) AS BIGINT) END AS cpb
FROM {gold} GROUP BY channel"""))
def q_overall_cpb(spark, sf_dir):
    """A13 over the cost-per-booking table."""
    cpb = M.cost_per_booking(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)
    return R.overall_cpb(cpb)


_DOW = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


@register("booking_heatmap", _wrap(TIME_E, "SELECT booking_hour, " + ", ".join(
    f"CAST(coalesce(sum(bookings_count) FILTER (WHERE booking_day_of_week = {d}), 0) AS BIGINT) AS {_DOW[d - 1]}"
    for d in [2, 3, 4, 5, 6, 7, 1]) + " FROM {gold} GROUP BY booking_hour"))
def q_booking_heatmap(spark, sf_dir):
    """Hour x weekday pivot."""
    return R.booking_heatmap(M.booking_time_analysis(silver_e(spark, sf_dir), clock=False))


@register("hourly_bookings", _wrap(TIME_E, "SELECT booking_hour, CAST(sum(bookings_count) AS BIGINT) AS bookings_count FROM {gold} GROUP BY booking_hour"))
def q_hourly_bookings(spark, sf_dir):
    """A15."""
    return R.hourly_bookings(M.booking_time_analysis(silver_e(spark, sf_dir), clock=False))


@register("dow_bookings", _wrap(TIME_E, """SELECT booking_day_of_week, CAST(sum(bookings_count) AS BIGINT) AS bookings_count,
  ['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday'][booking_day_of_week] AS day_name
  FROM {gold} GROUP BY booking_day_of_week"""))
def q_dow_bookings(spark, sf_dir):
    """A16 + F7."""
    return R.dow_bookings(M.booking_time_analysis(silver_e(spark, sf_dir), clock=False))


@register("meeting_load_kpis", _wrap(LOAD_O, """SELECT CAST(sum(total_meetings) AS BIGINT) AS total_meetings,
  max(max_meetings_in_week) AS max_meetings_in_week,
  round(avg(avg_meetings_per_week), 6) AS avg_meetings_per_week FROM {gold}"""))
def q_meeting_load_kpis(spark, sf_dir):
    """A18."""
    return R.meeting_load_kpis(M.employee_meeting_load(meetings_o(spark, sf_dir), clock=False))


@register("cumulative_bookings", _wrap(DAILY_E, """SELECT booking_date AS date, source, total_bookings,
  CAST(sum(total_bookings) OVER (PARTITION BY source ORDER BY booking_date ASC NULLS FIRST
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative FROM {gold}"""))
def q_cumulative_bookings(spark, sf_dir):
    """W10."""
    daily = M.daily_bookings_by_source(silver_e(spark, sf_dir), clock=False).select("booking_date", "source", "total_bookings")
    return R.cumulative_daily_bookings(daily)


@register("distinct_sources", _full("SELECT DISTINCT marketing_channel AS source FROM e_bookings", Q.E_BOOKINGS))
def q_distinct_sources(spark, sf_dir):
    """A20."""
    return A.distinct_sources(silver_e(spark, sf_dir))


_COUNT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNT_TABLES))
def q_row_counts(spark, sf_dir):
    """A19."""
    return A.row_counts({t: AD.read_table(spark, sf_dir, t) for t in _COUNT_TABLES})


@register("last_n_days", _wrap(DAILY_E, f"SELECT * FROM {{gold}} WHERE booking_date > DATE '{KPI_AS_OF}' - 7 AND booking_date <= DATE '{KPI_AS_OF}'"))
def q_last_n_days(spark, sf_dir):
    """Daily bookings of the 7 days to the as-of date."""
    return last_n_days(M.daily_bookings_by_source(silver_e(spark, sf_dir), clock=False), "booking_date", 7, KPI_AS_OF)


@register("series_by_source", _wrap(DAILY_E, "SELECT * FROM {gold} WHERE source = 'purchase'"))
def q_series_by_source(spark, sf_dir):
    """O3: one source's daily rows in date order."""
    return O.series(M.daily_bookings_by_source(silver_e(spark, sf_dir), clock=False), "source", "purchase", "booking_date")


@register("leaderboard_by_cpb", _wrap(ATTR_O, "SELECT channel, total_bookings, total_spend, cost_per_booking FROM {gold}"))
def q_leaderboard_by_cpb(spark, sf_dir):
    """O2: channels by cost per booking (ascending, nulls last)."""
    attr = M.channel_attribution(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)
    return O.leaderboard(attr.select("channel", "total_bookings", "total_spend", "cost_per_booking"), "cost_per_booking", True, "channel")


@register("coerce_gold_text", _wrap(CPB_O, "SELECT date, channel, total_spend, total_bookings, cost_per_booking, cumulative_spend, cumulative_bookings, cumulative_cpb FROM {gold}"))
def q_coerce_gold_text(spark, sf_dir):
    """P20: gold rows as text (as a SQL service returns them), coerced back to types."""
    cpb = M.cost_per_booking(silver_o(spark, sf_dir), AD.lineitem_spend(spark, sf_dir), clock=False)
    cols = ["date", "channel", "total_spend", "total_bookings", "cost_per_booking", "cumulative_spend", "cumulative_bookings", "cumulative_cpb"]
    text = cpb.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return coerce(text, {"date": "date", "total_spend": "double", "total_bookings": "bigint", "cost_per_booking": "double",
                         "cumulative_spend": "double", "cumulative_bookings": "bigint", "cumulative_cpb": "double"})


# ------------------------------------------------------------------ dedup, spend normalizer
@register("dedup_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
    l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_latest(spark, sf_dir):
    """Latest line item per (l_orderkey, l_linenumber), every other column as tie-break."""
    li = AD.read_table(spark, sf_dir, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return dedup_latest(li, ["l_orderkey", "l_linenumber"], latest_first("l_shipdate", rest))


@register("clean_spend", _full("""
SELECT date, channel, spend, ingested_at, source_file, ingestion_date,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day
FROM (SELECT *, row_number() OVER (PARTITION BY date, channel ORDER BY ingested_at DESC NULLS LAST, spend DESC NULLS LAST,
        source_file DESC NULLS LAST, ingestion_date DESC NULLS LAST) AS rn
      FROM o_spend WHERE date IS NOT NULL AND channel IS NOT NULL AND spend IS NOT NULL AND spend >= 0)
WHERE rn = 1""", Q.O_SPEND))
def q_clean_spend(spark, sf_dir):
    """X2 / P5 / P6 / P8 / W9 on adapter O spend records."""
    from slotflow.plans.normalize import clean_spend

    return clean_spend(AD.lineitem_spend(spark, sf_dir), clock=False)


@register("clean_bookings", _full("""
SELECT 'invitee.created' AS webhook_event, invitee_uri, invitee_email, marketing_channel, event_status AS invitee_status,
  event_status AS scheduled_event_status, start_time AS scheduled_event_start_time, event_status, invitee_canceled,
  booking_date, booking_year, booking_month, booking_day_of_week, booking_hour
FROM o_bookings""", Q.O_BOOKINGS))
def q_clean_bookings(spark, sf_dir):
    """X1 / P2 / P7 / F3-F8 on adapter O (columns the adapter fills)."""
    s = silver_o(spark, sf_dir)
    return s.select("webhook_event", "invitee_uri", "invitee_email", "marketing_channel", "invitee_status",
                    "scheduled_event_status", "scheduled_event_start_time", "event_status", "invitee_canceled",
                    "booking_date", "booking_year", "booking_month", "booking_day_of_week", "booking_hour")


@register("nest_spend", _full("""
SELECT date, channel, source_file, count(*) AS record_count, CAST(count(*) AS INTEGER) AS n_records,
  min(spend) AS min_spend, max(spend) AS max_spend
FROM o_spend GROUP BY date, channel, source_file""", Q.O_SPEND))
def q_nest_spend(spark, sf_dir):
    """Spend documents per (date, channel) and source file; record arrays summarized for
    comparison."""
    docs = A.nest_spend(AD.lineitem_spend(spark, sf_dir))
    return docs.select(
        "date", "channel", "source_file", "record_count", F.size("records").alias("n_records"),
        F.array_min(F.transform("records", lambda r: r["spend"])).alias("min_spend"),
        F.array_max(F.transform("records", lambda r: r["spend"])).alias("max_spend"),
    )


@register("flatten_records", _full("SELECT date, channel, spend, ingested_at, source_file, ingestion_date FROM o_spend", Q.O_SPEND))
def q_flatten_records(spark, sf_dir):
    """Nested spend documents back to rows (round trip of A17)."""
    from slotflow.operators.projections import flatten_records

    return flatten_records(A.nest_spend(AD.lineitem_spend(spark, sf_dir)).select("records"))


@register("union_spend", Q.with_ctes(Q.E_SPEND, Q.O_SPEND) + """
SELECT date, channel, spend, ingested_at, source_file, ingestion_date FROM e_spend
UNION ALL SELECT date, channel, spend, ingested_at, source_file, ingestion_date FROM o_spend""")
def q_union_spend(spark, sf_dir):
    """Bag union of two spend sources by column name."""
    return O.union_all([AD.events_spend(spark, sf_dir), AD.lineitem_spend(spark, sf_dir)])


# ------------------------------------------------------------------ webhooks and stream records (adapter N)
BOOKMARK_DAY = "2024-01-16"  # splits the events' days over two runs

_BRONZE_NO_CLOCK = [c.strip() for c in Q.BRONZE_COLUMNS.split(",")]
_SILVER_NO_CLOCK = [c.strip() for c in Q.SILVER_NO_CLOCK.split(",")]


def _envelopes(spark, sf_dir):
    """T1 output as it sits on the booking stream."""
    enriched = WH.process_webhooks(AD.events_requests(spark, sf_dir), AD.FIXTURE_EVENT_TYPE_CHANNELS, keep=["event_id", "_ts"])
    return AD.enriched_envelopes(enriched)


def _bronze_n(spark, sf_dir):
    good, _bad = WH.decode_to_bronze(_envelopes(spark, sf_dir), clock=False)
    return good


@register("flatten_booking", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE) + f"SELECT {Q.BRONZE_COLUMNS} FROM n_bronze")
def q_flatten_booking(spark, sf_dir):
    """T1 + T2 in batch form: P14 unwrap, P9 event filter, P10/J3/F24 allow-list, P11 enrich,
    S16 message JSON, base64 envelope, P15/F21/F22 decode, P12 flatten with F17-F20, F10, F23."""
    return _bronze_n(spark, sf_dir).select(*_BRONZE_NO_CLOCK)


@register("clean_bookings_nested", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE, Q.N_SILVER) + f"SELECT {Q.SILVER_NO_CLOCK} FROM n_silver")
def q_clean_bookings_nested(spark, sf_dir):
    """X1 on flattened webhook records: ISO text timestamps parsed, malformed start -> null
    parts, first/last name, cancel flag from the invitee status."""
    return clean_bookings(_bronze_n(spark, sf_dir)).select(*_SILVER_NO_CLOCK)


@register("batch_outcome", Q.with_ctes(Q.N_MSGS) + """
SELECT count(*) FILTER (WHERE NOT poison) AS processed, count(*) FILTER (WHERE poison) AS failed FROM n_msgs""")
def q_batch_outcome(spark, sf_dir):
    """Decoded vs failed records; poison rows are counted, not fatal."""
    return A.batch_outcome(tag_decode_errors(_envelopes(spark, sf_dir)))


@register("dead_letters", Q.with_ctes(Q.N_MSGS) + """
SELECT 'shard-0:' || lpad(CAST(event_id AS VARCHAR), 20, '0') AS sequence_number, channel AS partition_key,
  CASE WHEN event_id % 211 = 0 THEN 'invalid base64' ELSE 'invalid json' END AS error
FROM n_msgs WHERE poison""")
def q_dead_letters(spark, sf_dir):
    """The dead-letter rows with their error."""
    _good, bad = WH.decode_to_bronze(_envelopes(spark, sf_dir), clock=False)
    return bad.select("sequence_number", "partition_key", "error")


@register("stream_messages", Q.with_ctes(Q.N_MSGS) + """
SELECT channel AS key, 'inv-' || CAST(event_id AS VARCHAR) AS invitee_uri, event_type AS event_type_url,
  'invitee.created' AS webhook_event FROM n_msgs""")
def q_stream_messages(spark, sf_dir):
    """Keyed messages (key = channel); the value JSON is parsed back to check it."""
    from slotflow import schemas
    from slotflow.functions.nested import parse_json

    enriched = WH.process_webhooks(AD.events_requests(spark, sf_dir), AD.FIXTURE_EVENT_TYPE_CHANNELS)
    msgs = WH.enriched_to_message(enriched)
    back = msgs.select("key", parse_json(F.col("value"), schemas.ENRICHED).alias("m"))
    return back.select("key", F.col("m.invitee_data.uri").alias("invitee_uri"), F.col("m.event_type_url").alias("event_type_url"),
                       F.col("m.webhook_event").alias("webhook_event"))


# ------------------------------------------------------------------ scalar functions
@register("person_names", """
SELECT 'part' AS src, CAST(p_partkey AS VARCHAR) AS id, p_name AS full_name,
  regexp_extract(p_name, '^(\\S+)', 1) AS first_name, regexp_extract(p_name, '\\s+(\\S+)$', 1) AS last_name FROM part
UNION ALL
SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, regexp_extract(s_name, '^(\\S+)', 1),
  regexp_extract(s_name, '\\s+(\\S+)$', 1) FROM supplier""")
def q_person_names(spark, sf_dir):
    """F1 / F2 on two-word (part names) and one-word (supplier names) values."""
    from slotflow.functions.text import first_name, last_name

    p = AD.read_table(spark, sf_dir, "part").select(F.lit("part").alias("src"), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("full_name"))
    s = AD.read_table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("src"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("full_name"))
    both = p.unionByName(s)
    return both.select("src", "id", "full_name", first_name(F.col("full_name")).alias("first_name"), last_name(F.col("full_name")).alias("last_name"))


@register("date_parts", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS dom, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, dayname(ts) AS day_name,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(weekofyear(ts) AS INTEGER) AS iso_week,
  CAST(date_trunc('week', ts) AS DATE) AS week_start,
  strftime(ts, '%Y-%m-%d') AS ymd, strftime(ts, '%Y/%m/%d') AS ymd_path,
  CAST(ts AS DATE) - 1 AS execution_date,
  substr(strftime(ts, '%Y-%m-%d'), 1, 4) AS year_text, substr(strftime(ts, '%Y-%m-%d'), 6, 2) AS month_text
FROM events""")
def q_date_parts(spark, sf_dir):
    """F3-F9, F11, F23 and the F5 substring form on every event timestamp."""
    from slotflow.functions import timeparts as TP

    ev = AD.read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    day = TP.to_day(ts)
    return ev.select(
        "event_id", day.alias("day"), TP.year_of(ts).alias("year"), TP.month_of(ts).alias("month"),
        TP.day_of(ts).alias("dom"), TP.day_of_week(ts).alias("dow"), TP.day_name(ts).alias("day_name"),
        TP.hour_of(ts).alias("hour"), TP.iso_week(ts).alias("iso_week"), TP.week_start(ts).alias("week_start"),
        TP.format_day(ts).alias("ymd"), TP.format_day_path(ts).alias("ymd_path"),
        TP.execution_date(day).alias("execution_date"),
        F.substring(TP.format_day(ts), 1, 4).alias("year_text"), F.substring(TP.format_day(ts), 6, 2).alias("month_text"),
    )


@register("parse_timestamps", """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS start_time,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS start_hour FROM events""")
def q_parse_timestamps(spark, sf_dir):
    """ISO-8601 'Z' text to timestamps, malformed values to null (no job failure)."""
    from slotflow.functions.timeparts import parse_timestamp

    w = AD.events_webhooks(spark, sf_dir)
    start = parse_timestamp(F.col("webhook.payload.scheduled_event.start_time"))
    return w.select("event_id", start.alias("start_time"), F.hour(start).alias("start_hour"))


@register("channel_lookup", """
SELECT event_id, event_type, CASE event_type WHEN 'purchase' THEN 'search_ads' WHEN 'signup' THEN 'social_ads'
  WHEN 'view' THEN 'video_ads' END AS channel FROM events""")
def q_channel_lookup(spark, sf_dir):
    """map lookup (null for event types off the allow-list)."""
    from slotflow.functions.nested import lookup_channel

    ev = AD.read_table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", lookup_channel(F.col("event_type"), AD.FIXTURE_EVENT_TYPE_CHANNELS).alias("channel"))


@register("attribute_channel_join", """
SELECT event_id, event_type AS event_type_url, CASE event_type WHEN 'purchase' THEN 'search_ads' WHEN 'signup' THEN 'social_ads'
  WHEN 'view' THEN 'video_ads' END AS marketing_channel FROM events WHERE event_type IN ('purchase', 'signup', 'view')""")
def q_attribute_channel_join(spark, sf_dir):
    """Allow-list as a dimension table, inner equi-join (Spark broadcasts it by size)."""
    from slotflow.operators.joins import attribute_channel_join, channel_dimension

    ev = AD.read_table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("event_type_url"))
    return attribute_channel_join(ev, channel_dimension(spark, AD.FIXTURE_EVENT_TYPE_CHANNELS))


@register("sanitize_columns", """
SELECT event_id AS event_id, ts AS ts, user_id AS user_id, event_type AS event_type, value AS value_usd_, props AS props FROM events""")
def q_sanitize_columns(spark, sf_dir):
    """Column names cleaned (non [A-Za-z0-9_] -> '_', runs collapsed, lower case)."""
    ev = AD.read_table(spark, sf_dir, "events").toDF("Event ID", "TS", "user-id", "Event__Type", "Value (USD)", "props")
    return sanitize_columns(ev)


# ------------------------------------------------------------------ source files, spines


def _spend_file_names(spark, sf_dir):
    li = AD.read_table(spark, sf_dir, "lineitem")
    day = F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd")
    names = li.select(F.concat(F.lit("spend_data_"), day, F.lit(".json")).alias("file_name"))
    other = AD.read_table(spark, sf_dir, "orders").select(F.concat(F.lit("notes_"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("file_name"))
    return names.unionByName(other)


@register("source_file_dates", """
SELECT DISTINCT 'spend_data_' || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') || '.json' AS file_name,
  CAST(l_shipdate AS DATE) AS file_date FROM lineitem""")
def q_source_file_dates(spark, sf_dir):
    """Keep ``spend_data_*.json`` names, parse their dates (one row per file)."""
    return FL.source_dates(_spend_file_names(spark, sf_dir).distinct())


@register("latest_sources", """
SELECT * FROM (SELECT DISTINCT 'spend_data_' || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') || '.json' AS file_name,
  CAST(l_shipdate AS DATE) AS file_date FROM lineitem) ORDER BY file_date DESC LIMIT 30""")
def q_latest_sources(spark, sf_dir):
    """The 30 newest source files (a top-k report)."""
    return O.latest_sources(FL.source_dates(_spend_file_names(spark, sf_dir).distinct()), 30)


@register("date_spine", Q.with_ctes(Q.E_BOOKINGS) + """
, a AS (SELECT marketing_channel, max(booking_date) AS as_of FROM e_bookings GROUP BY marketing_channel)
SELECT marketing_channel, as_of, CAST(unnest(generate_series(as_of - INTERVAL 29 DAY, as_of, INTERVAL 1 DAY)) AS DATE) AS spine_date FROM a""")
def q_date_spine(spark, sf_dir):
    """30-day date spine ending at each channel's last booking date."""
    anchors = silver_e(spark, sf_dir).groupBy("marketing_channel").agg(F.max("booking_date").alias("as_of"))
    return O.date_spine(anchors, "as_of", 30)


# ------------------------------------------------------------------ keyed upserts (relational form)


@register("upsert_bookings", Q.with_ctes(Q.O_BOOKINGS) + """
, src AS (SELECT CAST(l_orderkey AS VARCHAR) AS invitee_uri, CAST(l_shipdate AS DATE) AS booking_date,
                 'rebooked' AS event_status, l_linenumber, l_shipdate, l_suppkey, l_partkey FROM lineitem)
, dedup AS (SELECT invitee_uri, booking_date, event_status FROM (
     SELECT *, row_number() OVER (PARTITION BY invitee_uri ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST,
       l_suppkey DESC NULLS LAST, l_partkey DESC NULLS LAST) AS rn FROM src) WHERE rn = 1)
SELECT t.invitee_uri, t.booking_date, t.event_status, t.marketing_channel FROM o_bookings t
WHERE NOT EXISTS (SELECT 1 FROM dedup d WHERE d.invitee_uri = t.invitee_uri)
UNION ALL SELECT invitee_uri, booking_date, event_status, CAST(NULL AS VARCHAR) FROM dedup""")
def q_upsert_bookings(spark, sf_dir):
    """Booking updates keyed by invitee_uri replace whole rows, new keys are
    inserted; the update batch is deduplicated latest-first; a column missing in the batch
    (marketing_channel) is null on updated rows (additive schema)."""
    target = silver_o(spark, sf_dir).select("invitee_uri", "booking_date", "event_status", "marketing_channel")
    li = AD.read_table(spark, sf_dir, "lineitem")
    src = li.select(F.col("l_orderkey").cast("string").alias("invitee_uri"), F.to_date("l_shipdate").alias("booking_date"),
                    F.lit("rebooked").alias("event_status"), "l_linenumber", "l_shipdate", "l_suppkey", "l_partkey")
    order = latest_first("l_shipdate", ["l_linenumber", "l_suppkey", "l_partkey"])
    merged = merge_upsert(target, src, ["invitee_uri"], order)
    return merged.select("invitee_uri", "booking_date", "event_status", "marketing_channel")


@register("upsert_spend", Q.with_ctes(Q.O_SPEND) + """
, tgt AS (SELECT date, channel, spend, ingested_at FROM (
    SELECT *, row_number() OVER (PARTITION BY date, channel ORDER BY ingested_at DESC NULLS LAST, spend DESC NULLS LAST,
      source_file DESC NULLS LAST, ingestion_date DESC NULLS LAST) AS rn FROM o_spend) WHERE rn = 1)
, src AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS channel, o_totalprice * 0.01 AS spend,
                 o_orderdate AS ingested_at, o_orderkey FROM orders)
, dedup AS (SELECT date, channel, spend, ingested_at FROM (
    SELECT *, row_number() OVER (PARTITION BY date, channel ORDER BY ingested_at DESC NULLS LAST, spend DESC NULLS LAST,
      o_orderkey DESC NULLS LAST) AS rn FROM src) WHERE rn = 1)
SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM dedup d WHERE d.date = t.date AND d.channel = t.channel)
UNION ALL SELECT * FROM dedup""")
def q_upsert_spend(spark, sf_dir):
    """Spend keyed by (date, channel): silver spend from line items, updated by a
    batch derived from orders (latest per key wins)."""
    from slotflow.plans.normalize import clean_spend

    target = clean_spend(AD.lineitem_spend(spark, sf_dir), clock=False).select("date", "channel", "spend", "ingested_at")
    o = AD.read_table(spark, sf_dir, "orders")
    src = o.select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("channel"),
                   (F.col("o_totalprice") * F.lit(0.01)).alias("spend"), F.col("o_orderdate").cast("timestamp").alias("ingested_at"), "o_orderkey")
    merged = merge_upsert(target, src, ["date", "channel"], latest_first("ingested_at", ["spend", "o_orderkey"]))
    return merged.select("date", "channel", "spend", "ingested_at")


# ------------------------------------------------------------------ jobs over files: streams and batch jobs


def _t2_bronze_dir(spark, sf_dir) -> str:
    """Run the T2 stream (availableNow) over staged envelopes plus a redelivered slice
    (every 7th record delivered twice, in a later file); returns the bronze folder."""
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "t2")
    env = _envelopes(spark, sf_dir).drop("event_id")
    env.write.mode("append").json(f"{base}/in")
    env.filter(F.substring("sequence_number", -2, 2).cast("int") % 7 == 0).write.mode("append").json(f"{base}/in")
    q = J.bronze_writer(spark, f"{base}/in", f"{base}/bronze", f"{base}/dead", f"{base}/ckpt", trigger={"availableNow": True})
    J.run_to_end(q)
    return f"{base}/bronze"


def _read_bronze(spark, path):
    return spark.read.schema(SC.BRONZE_BOOKING).option("recursiveFileLookup", "true").json(path)


@register("stream_bronze_bookings", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE) + f"SELECT {Q.BRONZE_COLUMNS} FROM n_bronze")
def q_stream_bronze_bookings(spark, sf_dir):
    """Streamed decode to bronze JSON; redeliveries dropped by the
    watermark dedup, poison rows diverted; the bronze files read back (S1)."""
    return _read_bronze(spark, _t2_bronze_dir(spark, sf_dir)).select(*_BRONZE_NO_CLOCK)


@register("stream_daily_counts", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE) + """
SELECT CASE WHEN _eid % 89 = 0 THEN DATE '2031-05-05' ELSE CAST(ts AS DATE) END AS date, marketing_channel AS channel,
  count(invitee_uri) AS total_bookings
FROM n_bronze WHERE _eid % 89 = 0 OR _eid % 97 <> 0 GROUP BY ALL""")
def q_stream_daily_counts(spark, sf_dir):
    """Live bookings per (day, channel) over four micro-batches of bronze files: three slices
    of the events with interleaved days and some appointments years ahead, then the second slice
    delivered again. Each slice is as many files as tasks wrote it. The counts equal the batch
    count (A3)."""
    from slotflow.plans.webhooks import decode_to_bronze
    from slotflow.sources import tables as TB
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "t7")
    eid = F.substring("kinesis_sequence_number", -20, 20).cast("long")
    start = F.when(eid % 89 == 0, "2031-05-05T10:00:00Z").otherwise(F.col("scheduled_event_start_time"))
    env, delivered = _envelopes(spark, sf_dir), []
    for part in (0, 1, 2):
        good, _bad = decode_to_bronze(env.where(F.col("event_id") % 3 == part))
        good.withColumn("scheduled_event_start_time", start).write.json(f"{base}/slices/{part}")
        delivered.append(TB.hand_over(spark, f"{base}/slices/{part}", f"{base}/bronze", f"slice-{part}"))
    again = spark.read.text([f"{base}/bronze/slice-1-*"]) if delivered[1] else spark.createDataFrame([], "value string")
    again.coalesce(max(1, delivered[1])).write.text(f"{base}/again")  # as many files: a micro-batch too
    delivered.append(TB.hand_over(spark, f"{base}/again", f"{base}/bronze", "slice-1-again"))
    J.run_to_end(J.live_daily_counts(spark, f"{base}/bronze", f"{base}/counts", f"{base}/ckpt", {"availableNow": True}, max_files_per_trigger=max(1, *delivered)))
    return spark.read.parquet(f"{base}/counts").select("date", "channel", "total_bookings")


def _bronze_files(spark, sf_dir, path):
    """Bronze booking files (JSON lines, partitioned channel=/date=) from the batch decode
    of the staged booking stream."""
    from slotflow.plans.webhooks import decode_to_bronze

    good, _bad = decode_to_bronze(_envelopes(spark, sf_dir))
    arrival = F.col("kinesis_arrival_timestamp").cast("timestamp").cast("date").cast("string")
    good.withColumns({"channel": F.col("marketing_channel"), "date": arrival}) \
        .write.partitionBy("channel", "date").json(path)
    return path


def _job_config(spark, name):
    from slotflow.config import PipelineConfig

    base = scratch_path(spark, name)
    return PipelineConfig(f"{base}/bronze", f"{base}/silver", f"{base}/gold", "slotflow_check", AD.FIXTURE_EVENT_TYPE_CHANNELS)


def _bronze_to_silver(spark, sf_dir):
    from slotflow.plans.batch_jobs import bronze_to_silver
    from slotflow.sources import tables as TB

    cfg = _job_config(spark, "x3")
    _bronze_files(spark, sf_dir, cfg.bronze_bookings)
    TB.write_bronze_spend(A.nest_spend(AD.events_spend(spark, sf_dir)), cfg.bronze_spend, "2024-01-31")
    bronze_to_silver(spark, cfg, multiline=False)
    return cfg


@register("bronze_to_silver_job", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE, Q.N_SILVER) + f"SELECT {Q.SILVER_NO_CLOCK} FROM n_silver")
def q_bronze_to_silver_job(spark, sf_dir):
    """X3 end to end: bronze booking JSON (S14 layout) and bronze spend documents
    -> silver tables (S4-S8) -> silver bookings read back (S3)."""
    return spark.read.parquet(_bronze_to_silver(spark, sf_dir).silver_bookings).select(*_SILVER_NO_CLOCK)


@register("bronze_to_silver_spend", _full("""
SELECT date, channel, spend, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, source_file
FROM (SELECT *, row_number() OVER (PARTITION BY date, channel ORDER BY ingested_at DESC NULLS LAST, spend DESC NULLS LAST) AS rn
      FROM e_spend WHERE spend >= 0) WHERE rn = 1""", Q.E_SPEND))
def q_bronze_to_silver_spend(spark, sf_dir):
    """X3, spend side: the documents of every event, one row per (date, channel) in silver."""
    silver = spark.read.parquet(_bronze_to_silver(spark, sf_dir).silver_spend)
    return silver.select("date", "channel", "spend", "year", "month", "day", "source_file")


def _silver_to_gold(spark, sf_dir, metric, whole=False):
    from slotflow.plans.batch_jobs import silver_to_gold
    from slotflow.sources import tables as TB

    cfg = _job_config(spark, "x10")
    load = metric == "employee_meeting_load"
    bookings = meetings_o(spark, sf_dir) if load else silver_o(spark, sf_dir)
    TB.write_silver_bookings(bookings, cfg.silver_bookings)
    # silver spend as loaded by an append-only loader: every record kept (no dedup here)
    spend = AD.lineitem_spend(spark, sf_dir).withColumns({"year": F.year("date"), "month": F.month("date")})
    TB.write_silver_spend(spend, cfg.silver_spend)
    errors: list[str] = []
    silver_to_gold(spark, cfg, None if whole else [metric], errors)
    if errors:
        raise RuntimeError(f"gold metrics failed: {errors}")
    return spark.read.parquet(f"{cfg.gold_metrics}/{metric}").drop("calculated_at")


def _register_gold(metric: str, sql: str) -> None:
    def query(spark, sf_dir):
        return _silver_to_gold(spark, sf_dir, metric)

    query.__name__ = f"q_silver_to_gold_{metric}"
    query.__doc__ = f"X10 end to end: silver written partitioned (S4, S5), the job run (S21), gold {metric} read back (S10)."
    register(f"silver_to_gold_{metric}", sql)(query)


for _metric, _sql in (
    ("daily_bookings_by_source", _full(Q.daily_bookings_sql("o_bookings"), Q.O_BOOKINGS)),
    ("cost_per_booking", CPB_O),
    ("bookings_trend", _full(Q.bookings_trend_sql("o_bookings"), Q.O_BOOKINGS)),
    ("channel_attribution", ATTR_O),
    ("booking_time_analysis", _full(Q.booking_time_sql("o_bookings"), Q.O_BOOKINGS)),
    ("employee_meeting_load", LOAD_O),
):
    _register_gold(_metric, _sql)


@register("silver_to_gold_job", CPB_O)
def q_silver_to_gold_job(spark, sf_dir):
    """X10 end to end: all six metrics in one job, cost per booking read back."""
    return _silver_to_gold(spark, sf_dir, "cost_per_booking", whole=True)


# ------------------------------------------------------------------ spend ingestion (X11)
_SOURCE_SQL = """
WITH el AS (
  SELECT event_id, user_id, props, CAST(ts AS DATE) AS date, event_type AS channel, value AS spend,
    'spend_data_' || strftime(ts, '%Y-%m-%d') || '.json' AS source_file, day(ts) = 13 AS broken
  FROM events)
"""
INGEST_DATE = "2024-02-01"


def _ingest(spark, sf_dir):
    from slotflow.plans.batch_jobs import ingest_spend

    cfg = _job_config(spark, "x11")
    source = scratch_path(spark, "spend-source")
    # a part a file: the lines of each follow each other in one task
    AD.spend_source_files(spark, sf_dir).drop("part").write.option("maxRecordsPerFile", AD.PART_RECORDS).partitionBy("file").text(source)
    ingest_spend(spark, source, cfg, lookback_days=100_000, execution_date=INGEST_DATE)
    return cfg


@register("ingest_spend_job", _SOURCE_SQL + f"""
SELECT date, channel, spend, CAST(user_id AS BIGINT) AS impressions, CAST(event_id % 5 AS BIGINT) AS clicks, channel AS kind, props, source_file,
  '{INGEST_DATE}' AS ingestion_date
FROM el WHERE NOT broken AND event_id % 97 <> 0""")
def q_ingest_spend_job(spark, sf_dir):
    """Every file ingested into bronze documents; the records
    read back, with fields that no schema of the library names."""
    docs = spark.read.option("recursiveFileLookup", "true").schema("records array<map<string,variant>>").json(_ingest(spark, sf_dir).bronze_spend)
    rec = docs.select(F.explode("records").alias("r"))
    get = lambda k, t: F.element_at("r", k).cast("string").cast(t).alias(k)
    flag = lambda k: F.try_variant_get(F.element_at("r", "flags"), f"$.{k}", "string")
    return rec.select(get("date", "date"), get("channel", "string"), get("spend", "double"), get("impressions", "long"),
                      get("clicks", "long"), flag("event_type").alias("kind"), flag("props").alias("props"), get("source_file", "string"), get("ingestion_date", "string"))


@register("spend_dead_letters", _SOURCE_SQL + f"""
SELECT source_file, 'not a JSON array' AS error, CAST(NULL AS BIGINT) AS element,
  CAST(count(*) FILTER (WHERE event_id % 97 <> 0) + ceil(count(*) / {AD.PART_RECORDS}.0) AS INTEGER) AS n FROM el WHERE broken GROUP BY ALL
UNION ALL SELECT source_file, 'not a JSON object', event_id, CAST(count(*) AS INTEGER) FROM el WHERE NOT broken AND event_id % 97 = 0 GROUP BY ALL""")
def q_spend_dead_letters(spark, sf_dir):
    """Files and records that do not parse, kept with their text: of a broken file a part for
    each object in it and one for what follows the last, in a day of several files one each."""
    dead = spark.read.schema("source_file string, body string, error string").option("recursiveFileLookup", "true").json(_ingest(spark, sf_dir).spend_dead_letters)
    element = F.when(F.col("error") == "not a JSON object", F.col("body").cast("long"))
    return dead.groupBy("source_file", "error", element.alias("element")).agg(F.count("*").cast("int").alias("n"))


# ------------------------------------------------------------------ upserts on disk
@register("upsert_bookings_table", Q.with_ctes(Q.O_BOOKINGS) + """
, versions AS (
  SELECT invitee_uri, booking_date, marketing_channel, CAST(NULL AS VARCHAR) AS note, 0 AS batch, start_time AS version FROM o_bookings
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_shipdate AS DATE), CASE WHEN l_linenumber = 1 THEN 'moved' ELSE 'other' END,
    'line ' || l_linenumber, 1, CASE WHEN l_orderkey % 5 = 0 THEN TIMESTAMP '1970-01-01' ELSE l_shipdate END
  FROM lineitem)
SELECT invitee_uri, booking_date, marketing_channel, note, CAST(year(booking_date) AS INTEGER) AS booking_year,
  CAST(month(booking_date) AS INTEGER) AS booking_month
FROM (SELECT *, row_number() OVER (PARTITION BY invitee_uri ORDER BY version DESC NULLS LAST, note DESC NULLS LAST) AS rn FROM versions) WHERE rn = 1""")
def q_upsert_bookings_table(spark, sf_dir):
    """S6 / S8 / S9 on disk: orders, then their line items as a second batch: bookings move to
    other partitions, gain a column, and a fifth of the batch is an older version that loses."""
    from slotflow.sources import readers as RD, tables as TB

    path = scratch_path(spark, "upsert-bookings")
    parts = lambda df: df.withColumns({"booking_year": F.year("booking_date"), "booking_month": F.month("booking_date")})
    first = silver_o(spark, sf_dir).select("invitee_uri", "booking_date", "marketing_channel", F.col("scheduled_event_start_time").cast("timestamp").alias("version"))
    li = AD.read_table(spark, sf_dir, "lineitem")
    version = F.when(F.col("l_orderkey") % 5 == 0, F.lit("1970-01-01").cast("timestamp")).otherwise(F.col("l_shipdate").cast("timestamp"))
    second = li.select(
        F.col("l_orderkey").cast("string").alias("invitee_uri"), F.to_date("l_shipdate").alias("booking_date"),
        F.when(F.col("l_linenumber") == 1, "moved").otherwise("other").alias("marketing_channel"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("note"), version.alias("version"),
    )
    TB.upsert_table(spark, path, parts(first), ["invitee_uri"], TB.BOOKING_PARTITIONS, latest_first("version", []))
    TB.upsert_table(spark, path, parts(second), ["invitee_uri"], TB.BOOKING_PARTITIONS, latest_first("version", ["note"]))
    return RD.read_silver(spark, path).drop("version")


@register("upsert_spend_table", Q.with_ctes(Q.O_SPEND) + """
, versions AS (
  SELECT date, channel, spend, ingested_at, CAST(NULL AS BIGINT) AS orderkey FROM o_spend
  UNION ALL
  SELECT CAST(o_orderdate AS DATE), o_orderpriority, o_totalprice * 0.01,
    CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1970-01-01' ELSE o_orderdate + INTERVAL 1 DAY END, o_orderkey FROM orders)
SELECT date, channel, spend, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, orderkey
FROM (SELECT *, row_number() OVER (PARTITION BY date, channel ORDER BY ingested_at DESC NULLS LAST, spend DESC NULLS LAST, orderkey DESC NULLS LAST) AS rn FROM versions) WHERE rn = 1""")
def q_upsert_spend_table(spark, sf_dir):
    """S7 on disk: spend of line items, then a batch from orders with newer and older versions and
    a new column."""
    from slotflow.sources import readers as RD, tables as TB

    path = scratch_path(spark, "upsert-spend")
    parts = lambda df: df.withColumns({"year": F.year("date"), "month": F.month("date")})
    o = AD.read_table(spark, sf_dir, "orders")
    late = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1970-01-01").cast("timestamp")).otherwise((F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("timestamp"))
    batch = o.select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("channel"),
                     (F.col("o_totalprice") * F.lit(0.01)).alias("spend"), late.alias("ingested_at"), F.col("o_orderkey").cast("long").alias("orderkey"))
    first = AD.lineitem_spend(spark, sf_dir).select("date", "channel", "spend", "ingested_at")
    keys, cols = ["date", "channel"], TB.SPEND_PARTITIONS
    TB.upsert_table(spark, path, parts(first), keys, cols, latest_first("ingested_at", ["spend"]), partitions_follow_keys=True)
    TB.upsert_table(spark, path, parts(batch), keys, cols, latest_first("ingested_at", ["spend", "orderkey"]), partitions_follow_keys=True)
    return RD.read_silver(spark, path).drop("ingested_at")


# ------------------------------------------------------------------ request shapes, archive, default channel
@register("unwrap_body_shapes", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'invitee.canceled' ELSE 'invitee.created' END AS event, 'inv-' || event_id AS uri,
  event_type AS event_type_url FROM events""")
def q_unwrap_body_shapes(spark, sf_dir):
    """The webhook as JSON text, as an object, or as the request itself, a third each."""
    from slotflow.operators.projections import unwrap_body

    w = AD.events_webhooks(spark, sf_dir)
    text = w.where("event_id % 3 = 0").select("event_id", F.to_json("webhook").alias("body"))
    whole = w.where("event_id % 3 = 1").select("event_id", F.col("webhook").alias("body"))
    direct = w.where("event_id % 3 = 2").select("event_id", "webhook.*")
    shape = lambda df: unwrap_body(df, ["event_id"]).select("event_id", "event", F.col("payload.uri").alias("uri"), F.col("payload.scheduled_event.event_type").alias("event_type_url"))
    return shape(text).unionByName(shape(whole)).unionByName(shape(direct))


@register("webhook_archive", Q.with_ctes(Q.N_MSGS) + """
SELECT 'invitee.created' AS event, 'inv-' || CAST(event_id AS VARCHAR) AS uri, event_type AS event_type_url FROM n_msgs""")
def q_webhook_archive(spark, sf_dir):
    """The streamed audit archive (tracked webhooks only) read back from its files."""
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "s15")
    AD.events_requests(spark, sf_dir).select("body").write.text(f"{base}/requests")
    J.run_to_end(J.webhook_intake(spark, f"{base}/requests", f"{base}/messages", f"{base}/archive", f"{base}/ckpt",
                                  AD.FIXTURE_EVENT_TYPE_CHANNELS, trigger={"availableNow": True}))
    archive = spark.read.schema("event string, received_date string, body string").json(f"{base}/archive")
    return archive.select("event", F.get_json_object("body", "$.payload.uri").alias("uri"),
                          F.get_json_object("body", "$.payload.scheduled_event.event_type").alias("event_type_url"))


@register("default_channel", """
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'search_ads' WHEN 'signup' THEN 'social_ads' WHEN 'view' THEN 'video_ads'
  ELSE 'direct' END AS marketing_channel FROM events""")
def q_default_channel(spark, sf_dir):
    """Events whose type has no channel get the default one."""
    from slotflow.functions.nested import lookup_channel
    from slotflow.operators.projections import default_channel

    ev = AD.read_table(spark, sf_dir, "events")
    return default_channel(ev.select("event_id", lookup_channel(F.col("event_type"), AD.FIXTURE_EVENT_TYPE_CHANNELS).alias("marketing_channel")))


@register("stream_webhook_intake", Q.with_ctes(Q.N_MSGS) + """
SELECT channel AS key, 'inv-' || CAST(event_id AS VARCHAR) AS invitee_uri, event_type AS event_type_url,
  'invitee.created' AS webhook_event FROM n_msgs""")
def q_stream_webhook_intake(spark, sf_dir):
    """T1 / S15 / S16 as a stream: request bodies as text files -> enriched keyed messages
    (file sink, exactly-once) and the raw audit archive; the messages read back."""
    from slotflow import schemas
    from slotflow.functions.nested import parse_json
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "t1")
    AD.events_requests(spark, sf_dir).select("body").write.text(f"{base}/requests")
    J.run_to_end(J.webhook_intake(spark, f"{base}/requests", f"{base}/messages", f"{base}/archive", f"{base}/ckpt",
                                  AD.FIXTURE_EVENT_TYPE_CHANNELS, trigger={"availableNow": True}))
    msgs = J.read_messages(spark, f"{base}/messages")
    back = msgs.select("key", parse_json(F.col("value"), schemas.ENRICHED).alias("m"))
    return back.select("key", F.col("m.invitee_data.uri").alias("invitee_uri"), F.col("m.event_type_url").alias("event_type_url"),
                       F.col("m.webhook_event").alias("webhook_event"))


@register("message_order", Q.with_ctes(Q.N_MSGS) + """
SELECT channel AS key, event_id, CAST(row_number() OVER (PARTITION BY channel ORDER BY event_id) AS INTEGER) AS place FROM n_msgs""")
def q_message_order(spark, sf_dir):
    """Three lots of request files that arrive one after the other, each a micro-batch; the
    messages read back, with their place within their channel by the sequence they carry."""
    from slotflow.functions.nested import parse_json
    from slotflow.sources import tables as TB
    from slotflow.sources.staging import drop_staged, stage
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "s16")
    requests = stage(AD.events_requests(spark, sf_dir).select("event_id", "body"), "requests")
    bounds = requests.agg(F.percentile_approx("event_id", [0.33, 0.66], 1000)).first()[0] or [0, 0]
    for part in range(3):
        low, high = ([None, *bounds][part], [*bounds, None][part])
        own = requests.where((F.lit(low is None) | (F.col("event_id") > F.lit(low))) & (F.lit(high is None) | (F.col("event_id") <= F.lit(high))))
        files = max(1, -(-own.count() // O.ROWS_A_SPLIT))
        own.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").select("body").write.mode("overwrite").text(f"{base}/lots/{part}")
        arrived = TB.hand_over(spark, f"{base}/lots/{part}", f"{base}/requests", f"lot-{part}")
        J.run_to_end(J.webhook_intake(spark, f"{base}/requests", f"{base}/messages", f"{base}/archive", f"{base}/ckpt",
                                      AD.FIXTURE_EVENT_TYPE_CHANNELS, trigger={"availableNow": True}, max_files_per_trigger=max(1, arrived)))
    drop_staged(requests)
    msgs = J.read_messages(spark, f"{base}/messages").select("key", "sequence", parse_json(F.col("value"), SC.ENRICHED)["invitee_data"]["uri"].alias("uri"))
    rows = stage(msgs.select("key", "sequence", F.regexp_extract("uri", "([0-9]+)$", 1).cast("long").alias("event_id")), "messages-read")
    return O.number_in_groups(rows, ["key"], ["sequence"], "place").select("key", "event_id", F.col("place").cast("int").alias("place"))


@register("bronze_bookmark_runs", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE) + f"""
, b AS (SELECT invitee_uri, CAST(ts AS DATE) AS day, CASE WHEN CAST(ts AS DATE) < DATE '{BOOKMARK_DAY}' THEN 1 ELSE 2 END AS run FROM n_bronze)
SELECT run, CAST(count(DISTINCT day) AS INTEGER) AS dates, CAST(count(DISTINCT invitee_uri) AS BIGINT) AS bookings,
  CAST((SELECT count(DISTINCT invitee_uri) FROM b AS every WHERE every.run <= b.run) AS BIGINT) AS in_silver FROM b GROUP BY run
UNION ALL SELECT 3, 0, 0, (SELECT count(DISTINCT invitee_uri) FROM b)""")
def q_bronze_bookmark_runs(spark, sf_dir):
    """Three runs over a growing bronze: the days before a date, then the others,
    then nothing new. Each run reads only dates that changed since the last."""
    from slotflow.plans.batch_jobs import bronze_to_silver

    cfg = _job_config(spark, "s23")
    good = _bronze_n(spark, sf_dir).withColumn("day", F.col("kinesis_arrival_timestamp").cast("timestamp").cast("date"))
    out = []
    for run, part in ((1, F.col("day") < BOOKMARK_DAY), (2, F.col("day") >= BOOKMARK_DAY), (3, None)):
        if part is not None:
            own = good.where(part).withColumns({"channel": F.col("marketing_channel"), "date": F.col("day").cast("string")}).drop("day")
            own.hint("rebalance", "channel", "date").write.mode("append").partitionBy("channel", "date").json(cfg.bronze_bookings)
        done = bronze_to_silver(spark, cfg, multiline=False, bookmark=True)
        out.append((run, done["dates"], done["bookings"], spark.read.parquet(cfg.silver_bookings).count()))
    return spark.createDataFrame(out, "run int, dates int, bookings long, in_silver long")


@register("batch_counters", Q.with_ctes(Q.N_MSGS) + """
SELECT count(*) FILTER (WHERE NOT poison) AS processed, count(*) FILTER (WHERE poison) AS failed FROM n_msgs""")
def q_batch_counters(spark, sf_dir):
    """The counts that the booking stream's micro-batches observed, kept as a table by a
    listener; over all batches they equal A21."""
    from slotflow.streaming import counters as CT, jobs as J

    base = scratch_path(spark, "s21")
    _envelopes(spark, sf_dir).drop("event_id").repartition(4).write.json(f"{base}/in")
    listener = CT.Counters(spark, f"{base}/counters")
    spark.streams.addListener(listener)
    try:
        query = J.bronze_writer(spark, f"{base}/in", f"{base}/bronze", f"{base}/dead", f"{base}/ckpt", {"availableNow": True}, max_files_per_trigger=2)
        J.run_to_end(query)
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    kept = CT.read_counters(spark, f"{base}/counters").where("metric = 'bronze_batch'")
    total = lambda name: F.coalesce(F.sum(F.when(F.col("name") == name, F.col("value"))), F.lit(0)).alias(name)
    return kept.agg(total("processed"), total("failed"))


@register("stream_from_latest", Q.with_ctes(Q.N_MSGS) + """
SELECT 'shard-0:' || lpad(CAST(event_id AS VARCHAR), 20, '0') AS sequence_number FROM n_msgs WHERE NOT poison AND event_id % 2 = 1""")
def q_stream_from_latest(spark, sf_dir):
    """T5: a stream that starts at the latest record: files there before its first start are left
    out unread, files that come later are read."""
    from slotflow.streaming import jobs as J

    base = scratch_path(spark, "t5")
    env = _envelopes(spark, sf_dir)
    for part in (0, 1):
        env.where(F.col("event_id") % 2 == part).drop("event_id").write.mode("append").json(f"{base}/in")
        J.run_to_end(J.bronze_writer(spark, f"{base}/in", f"{base}/bronze", f"{base}/dead", f"{base}/ckpt", {"availableNow": True}, start="latest"))
    return _read_bronze(spark, f"{base}/bronze").select(F.col("kinesis_sequence_number").alias("sequence_number"))


@register("discovered_tables", Q.with_ctes(Q.O_BOOKINGS) + """
SELECT booking_year, marketing_channel, count(*) AS bookings, count(*) FILTER (WHERE booking_year % 2 = 1) AS with_note,
  'booking_date,booking_year,invitee_uri,marketing_channel,note' AS columns FROM o_bookings GROUP BY booking_year, marketing_channel""")
def q_discovered_tables(spark, sf_dir):
    """A folder of Parquet partitions of which some have a column more, found and registered:
    its columns over all partitions, and its partitions read through the catalog."""
    from slotflow.sources import tables as TB

    base = scratch_path(spark, "s12")
    rows = silver_o(spark, sf_dir).select("invitee_uri", "booking_date", "booking_year", "marketing_channel")
    for odd, part in ((0, rows), (1, rows.withColumn("note", F.concat(F.lit("n"), "invitee_uri")))):
        part.where(F.col("booking_year") % 2 == odd).hint("rebalance", "booking_year", "marketing_channel") \
            .write.mode("append").partitionBy("booking_year", "marketing_channel").parquet(f"{base}/found")
    db = "slotflow_found_" + base.rsplit("-", 1)[-1]
    if not TB.discover_tables(spark, db, base).get("found"):
        raise RuntimeError("the table was not registered")
    table = spark.table(f"`{db}`.found")
    return table.groupBy("booking_year", "marketing_channel").agg(
        F.count("*").alias("bookings"), F.count("note").alias("with_note"), F.lit(",".join(sorted(table.columns))).alias("columns"))


@register("compacted_bronze", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE) + """
SELECT strftime(ts, '%Y-%m-%d') AS date, marketing_channel AS channel, count(invitee_uri) AS total_bookings FROM n_bronze GROUP BY ALL""")
def q_compacted_bronze(spark, sf_dir):
    """Bronze days in micro-batch folders, compacted, with a batch that comes after that
    and a compaction that died before it had removed what it replaced: every row counts once."""
    from slotflow.sources import readers as RD
    from slotflow.streaming import jobs as J

    bronze, dead = (scratch_path(spark, f"s14-{n}") for n in ("bronze", "dead"))
    env = tag_decode_errors(_envelopes(spark, sf_dir))
    for batch in range(4):
        J.write_bronze_batch(env.where(F.col("event_id") % 4 == batch).drop("event_id"), bronze, dead, batch)
        if batch in (1, 2):  # in batch 2 the days are compacted, but nothing is removed
            J.compact_bronze(spark, bronze, "*", remove=batch == 1)
    return RD.read_bronze_bookings(spark, bronze, multiline=False).groupBy(F.col("date_part").alias("date"), F.col("channel_part").alias("channel")).agg(
        F.count("invitee_uri").alias("total_bookings"))


@register("meeting_load_nested", Q.with_ctes(Q.N_MSGS, Q.N_BRONZE, Q.N_SILVER) + """
, n_meet AS (SELECT host_email, host_name, scheduled_event_start_time AS start_time FROM n_silver)""" + Q.meeting_load_sql("n_meet"))
def q_meeting_load_nested(spark, sf_dir):
    """X9 / A9 on hosts taken from the webhooks (first event membership, F19) through bronze
    and silver: meetings per host per ISO week, then per-host load."""
    return M.employee_meeting_load(clean_bookings(_bronze_n(spark, sf_dir)), clock=False)


@register("clean_bookings_nested_docs",
          Q.with_ctes(Q.N_MSGS_ALL, Q.N_BRONZE_ALL, Q.N_SILVER) + f"SELECT {Q.SILVER_NO_CLOCK} FROM n_silver")
def q_clean_bookings_nested_docs(spark, sf_dir):
    """X1 on the nested bronze document shape (Q11): every webhook of the events table, kept
    whole under payload.payload, normalized to silver."""
    return clean_bookings(AD.nested_bronze_documents(spark, sf_dir)).select(*_SILVER_NO_CLOCK)
