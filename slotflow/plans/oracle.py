"""DuckDB SQL for the adapters (CTEs) and the per-query oracle statements.

The CTEs restate, in SQL, the adapters of ``slotflow.sources.adapters`` followed by the
silver normalizer (X1) where a query reads silver bookings. DuckDB numbering differs from
Spark's in two places, handled here: ``dayofweek`` is 0 = Sunday (Spark: 1 = Sunday) and
date parts / sums come back as BIGINT / HUGEINT (cast to Spark's INTEGER / BIGINT).
"""

from __future__ import annotations

E_BOOKINGS = """
e_bookings AS (
  SELECT 'inv-' || CAST(event_id AS VARCHAR) AS invitee_uri,
         'u' || CAST(user_id AS VARCHAR) || '@example.com' AS invitee_email,
         event_type AS marketing_channel,
         CASE WHEN event_id % 10 = 0 THEN 'canceled' ELSE 'active' END AS event_status,
         (event_id % 10 = 0) AS invitee_canceled,
         ts AS start_time,
         CAST(ts AS DATE) AS booking_date,
         CAST(year(ts) AS INTEGER) AS booking_year,
         CAST(month(ts) AS INTEGER) AS booking_month,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS booking_day_of_week,
         CAST(hour(ts) AS INTEGER) AS booking_hour
  FROM events)"""

E_SPEND = """
e_spend AS (
  SELECT CAST(ts AS DATE) AS date, CASE WHEN event_type = 'view' THEN 'display' ELSE event_type END AS channel, value AS spend, ts AS ingested_at,
         'spend_data_' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '.json' AS source_file,
         CAST(ts AS DATE) AS ingestion_date
  FROM events)"""

O_BOOKINGS = """
o_bookings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS invitee_uri,
         CAST(o_custkey AS VARCHAR) AS invitee_email,
         o_orderpriority AS marketing_channel,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' WHEN 'P' THEN 'canceled' END AS event_status,
         (CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' WHEN 'P' THEN 'canceled' END) = 'canceled' AS invitee_canceled,
         o_orderdate AS start_time,
         CAST(o_orderdate AS DATE) AS booking_date,
         CAST(year(o_orderdate) AS INTEGER) AS booking_year,
         CAST(month(o_orderdate) AS INTEGER) AS booking_month,
         CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS booking_day_of_week,
         CAST(hour(o_orderdate) AS INTEGER) AS booking_hour
  FROM orders)"""

O_SPEND = """
o_spend AS (
  SELECT CAST(l_shipdate AS DATE) AS date, o_orderpriority AS channel,
         l_extendedprice * l_discount AS spend, o_orderdate AS ingested_at,
         'spend_data_' || strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') || '.json' AS source_file,
         CAST(o_orderdate AS DATE) AS ingestion_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

O_MEETINGS = """
o_meetings AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS invitee_uri,
         s_name || '@example.com' AS host_email, s_name AS host_name, l_shipdate AS start_time
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


MONEY = "DECIMAL(38,6)"


def daily_bookings_sql(src: str) -> str:
    return f"""
SELECT booking_date, marketing_channel AS source,
  count(invitee_uri) AS total_bookings,
  count(DISTINCT invitee_email) AS unique_emails,
  count(*) FILTER (WHERE event_status = 'active') AS active_bookings,
  count(*) FILTER (WHERE invitee_canceled = true) AS cancelled_bookings,
  CAST(count(*) FILTER (WHERE invitee_canceled = true) AS DOUBLE) / CAST(count(invitee_uri) AS DOUBLE) * 100 AS cancellation_rate,
  CAST(year(booking_date) AS INTEGER) AS year,
  CAST(month(booking_date) AS INTEGER) AS month,
  CAST(day(booking_date) AS INTEGER) AS day,
  CAST(dayofweek(booking_date) + 1 AS INTEGER) AS day_of_week,
  'daily_bookings_by_source' AS metric_name
FROM {src} GROUP BY booking_date, marketing_channel"""


def cost_per_booking_sql(bookings: str, spend: str) -> str:
    return f"""
, sp AS (SELECT date, channel, sum(CAST(spend AS {MONEY})) AS total_spend FROM {spend} GROUP BY date, channel)
, bk AS (SELECT booking_date AS date, marketing_channel AS channel, count(invitee_uri) AS total_bookings
         FROM {bookings} GROUP BY booking_date, marketing_channel)
, j AS (SELECT coalesce(sp.date, bk.date) AS date, coalesce(sp.channel, bk.channel) AS channel,
               coalesce(sp.total_spend, 0) AS total_spend_dec, coalesce(bk.total_bookings, 0) AS total_bookings
        FROM sp FULL OUTER JOIN bk ON sp.date = bk.date AND sp.channel = bk.channel)
, c AS (SELECT date, channel, total_spend_dec, total_bookings,
          sum(total_spend_dec) OVER w AS cum_spend_dec,
          CAST(sum(total_bookings) OVER w AS BIGINT) AS cumulative_bookings
        FROM j
        WINDOW w AS (PARTITION BY channel ORDER BY date ASC NULLS FIRST, total_spend_dec ASC NULLS FIRST,
                     total_bookings ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT date, channel, CAST(total_spend_dec AS DOUBLE) AS total_spend, total_bookings,
  CASE WHEN total_bookings > 0 THEN CAST(total_spend_dec AS DOUBLE) / total_bookings END AS cost_per_booking,
  CAST(cum_spend_dec AS DOUBLE) AS cumulative_spend, cumulative_bookings,
  CASE WHEN cumulative_bookings > 0 THEN CAST(cum_spend_dec AS DOUBLE) / cumulative_bookings END AS cumulative_cpb,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  'cost_per_booking' AS metric_name
FROM c"""


def bookings_trend_sql(src: str) -> str:
    return f"""
, d AS (SELECT booking_date AS date, marketing_channel AS source, count(invitee_uri) AS bookings_count
        FROM {src} GROUP BY booking_date, marketing_channel)
SELECT date, source, bookings_count,
  avg(bookings_count) OVER (PARTITION BY source ORDER BY date ASC NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg_7d,
  avg(bookings_count) OVER (PARTITION BY source ORDER BY date ASC NULLS FIRST ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_avg_30d,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(year(date) AS INTEGER) AS year,
  'bookings_trend_daily' AS metric_name
FROM d"""


def channel_attribution_sql(bookings: str, spend: str) -> str:
    return f"""
, cb AS (SELECT marketing_channel, count(invitee_uri) AS total_bookings, count(DISTINCT invitee_email) AS unique_leads
         FROM {bookings} GROUP BY marketing_channel)
, cs AS (SELECT channel, sum(CAST(spend AS {MONEY})) AS total_spend FROM {spend} GROUP BY channel)
, j AS (SELECT coalesce(cs.channel, cb.marketing_channel) AS channel,
               coalesce(cb.total_bookings, 0) AS total_bookings, coalesce(cb.unique_leads, 0) AS unique_leads,
               coalesce(CAST(cs.total_spend AS DOUBLE), 0.0) AS total_spend
        FROM cs FULL OUTER JOIN cb ON cs.channel = cb.marketing_channel)
, m AS (SELECT *, CASE WHEN total_bookings > 0 THEN total_spend / total_bookings END AS cost_per_booking,
               CASE WHEN unique_leads > 0 THEN total_spend / unique_leads END AS cost_per_lead FROM j)
SELECT *,
  CAST(row_number() OVER (ORDER BY total_bookings DESC NULLS LAST, channel ASC NULLS FIRST) AS INTEGER) AS rank_by_bookings,
  CAST(row_number() OVER (ORDER BY cost_per_booking ASC NULLS LAST, channel ASC NULLS FIRST) AS INTEGER) AS rank_by_cpb,
  'channel_attribution' AS metric_name
FROM m"""


def booking_time_sql(src: str) -> str:
    return f"""
, s AS (SELECT booking_hour, booking_day_of_week, marketing_channel, count(invitee_uri) AS bookings_count
        FROM {src} GROUP BY booking_hour, booking_day_of_week, marketing_channel)
SELECT *, CAST(sum(bookings_count) OVER (PARTITION BY marketing_channel) AS BIGINT) AS total_channel_bookings,
  CAST(bookings_count AS DOUBLE) / CAST(sum(bookings_count) OVER (PARTITION BY marketing_channel) AS DOUBLE) * 100 AS percentage_of_channel,
  'booking_time_analysis' AS metric_name
FROM s"""


def meeting_load_sql(src: str) -> str:
    return f"""
, w AS (SELECT host_email, host_name, CAST(date_trunc('week', start_time) AS DATE) AS week_start, count(*) AS meetings
        FROM {src} WHERE host_email IS NOT NULL AND start_time IS NOT NULL GROUP BY ALL)
SELECT host_email, host_name, avg(meetings) AS avg_meetings_per_week, CAST(sum(meetings) AS BIGINT) AS total_meetings,
  count(*) AS weeks_active, max(meetings) AS max_meetings_in_week, min(meetings) AS min_meetings_in_week,
  'employee_meeting_load' AS metric_name
FROM w GROUP BY host_email, host_name"""



# Adapter N: webhook documents from events, the allow-list and the poison rows.
N_MSGS = """
n_msgs AS (
  SELECT event_id, ts, user_id, event_type, props,
         CASE event_type WHEN 'purchase' THEN 'search_ads' WHEN 'signup' THEN 'social_ads'
                         WHEN 'view' THEN 'video_ads' END AS channel,
         CASE WHEN event_id % 10 = 0 THEN 'canceled' ELSE 'active' END AS status,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_iso,
         (event_id % 101 = 0 OR event_id % 211 = 0) AS poison
  FROM events
  WHERE event_id % 4 <> 0 AND event_type IN ('purchase', 'signup', 'view'))"""

N_BRONZE = """
n_bronze AS (
  SELECT 'event-shard-0-' || lpad(CAST(event_id AS VARCHAR), 20, '0') AS event_id,
    'shard-0:' || lpad(CAST(event_id AS VARCHAR), 20, '0') AS kinesis_sequence_number,
    channel AS kinesis_partition_key,
    CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS kinesis_arrival_timestamp,
    'invitee.created' AS webhook_event,
    ts_iso AS webhook_created_at,
    channel AS marketing_channel,
    event_type AS event_type_url,
    'inv-' || CAST(event_id AS VARCHAR) AS invitee_uri,
    'u' || CAST(user_id AS VARCHAR) || '@example.com' AS invitee_email,
    'User ' || CAST(user_id AS VARCHAR) AS invitee_name,
    CAST(NULL AS VARCHAR) AS invitee_first_name,
    CAST(NULL AS VARCHAR) AS invitee_last_name,
    ts_iso AS invitee_created_at,
    status AS invitee_status,
    'UTC' AS invitee_timezone,
    CASE WHEN event_id % 3 = 0 THEN '+1-555-' || CAST(event_id AS VARCHAR) END AS invitee_phone,
    'se-' || CAST(event_id AS VARCHAR) AS scheduled_event_uri,
    'Intro call' AS scheduled_event_name,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-time' ELSE ts_iso END AS scheduled_event_start_time,
    strftime(ts + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S.%fZ') AS scheduled_event_end_time,
    ts_iso AS scheduled_event_created_at,
    status AS scheduled_event_status,
    'zoom' AS scheduled_event_location_type,
    'https://example.com/meet' AS scheduled_event_location,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'host' || CAST(user_id % 9 AS VARCHAR) || '@example.com' END AS host_email,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'Host ' || CAST(user_id % 9 AS VARCHAR) END AS host_name,
    event_type AS utm_source, 'cpc' AS utm_medium, 'camp-' || CAST(user_id % 7 AS VARCHAR) AS utm_campaign,
    CAST(NULL AS VARCHAR) AS utm_content, CAST(NULL AS VARCHAR) AS utm_term,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS booking_date,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(year(ts) AS INTEGER) END AS booking_year,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(month(ts) AS INTEGER) END AS booking_month,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(day(ts) AS INTEGER) END AS booking_day,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS booking_hour,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE dayname(ts) END AS booking_day_of_week,
    ts, user_id, event_id AS _eid
  FROM n_msgs WHERE NOT poison)"""

# The same for every event, tracked or not (nested bronze documents).
N_MSGS_ALL = N_MSGS.split("\n  WHERE")[0] + ")"
N_BRONZE_ALL = N_BRONZE.replace("FROM n_msgs WHERE NOT poison", "FROM n_msgs").replace(
    "'invitee.created' AS webhook_event",
    "CASE WHEN event_id % 4 = 0 THEN 'invitee.canceled' ELSE 'invitee.created' END AS webhook_event",
)

N_SILVER = """
n_silver AS (
  SELECT webhook_event, marketing_channel, event_type_url, invitee_uri, invitee_email, invitee_name,
    invitee_status, invitee_timezone, invitee_phone,
    ts AS invitee_created_at, CAST(NULL AS TIMESTAMP) AS invitee_updated_at,
    scheduled_event_name, scheduled_event_status,
    CASE WHEN _eid % 97 = 0 THEN NULL ELSE ts END AS scheduled_event_start_time,
    ts + INTERVAL 30 MINUTE AS scheduled_event_end_time,
    utm_campaign, utm_source, utm_medium, utm_content, utm_term, host_email, host_name,
    regexp_extract(invitee_name, '^(\\S+)', 1) AS invitee_first_name,
    regexp_extract(invitee_name, '\\s+(\\S+)$', 1) AS invitee_last_name,
    scheduled_event_status AS event_status,
    lower(invitee_status) = 'canceled' AS invitee_canceled,
    CASE WHEN _eid % 97 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS booking_date,
    booking_year, booking_month,
    CASE WHEN _eid % 97 = 0 THEN NULL ELSE CAST(dayofweek(ts) + 1 AS INTEGER) END AS booking_day_of_week,
    booking_hour
  FROM n_bronze)"""

BRONZE_COLUMNS = (
    "event_id, kinesis_sequence_number, kinesis_partition_key, kinesis_arrival_timestamp, webhook_event, "
    "webhook_created_at, marketing_channel, event_type_url, invitee_uri, invitee_email, invitee_name, "
    "invitee_first_name, invitee_last_name, invitee_created_at, invitee_status, invitee_timezone, invitee_phone, "
    "scheduled_event_uri, scheduled_event_name, scheduled_event_start_time, scheduled_event_end_time, "
    "scheduled_event_created_at, scheduled_event_status, scheduled_event_location_type, scheduled_event_location, "
    "host_email, host_name, utm_source, utm_medium, utm_campaign, utm_content, utm_term, booking_date, "
    "booking_year, booking_month, booking_day, booking_hour, booking_day_of_week"
)

SILVER_NO_CLOCK = (
    "webhook_event, marketing_channel, event_type_url, invitee_uri, invitee_email, invitee_name, invitee_status, "
    "invitee_timezone, invitee_phone, invitee_created_at, invitee_updated_at, scheduled_event_name, "
    "scheduled_event_status, scheduled_event_start_time, scheduled_event_end_time, utm_campaign, utm_source, "
    "utm_medium, utm_content, utm_term, host_email, host_name, invitee_first_name, invitee_last_name, "
    "event_status, invitee_canceled, booking_date, booking_year, booking_month, booking_day_of_week, booking_hour"
)
