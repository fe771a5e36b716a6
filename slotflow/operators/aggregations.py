"""Aggregations.

Every aggregate here is algebraic (count, sum, min, max, avg) or a distinct count, so Spark
runs a partial aggregate before the shuffle: a key holding a third of the rows collapses to
one row per map task before it is exchanged. Money sums run in DECIMAL (exact, order-free).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotflow.functions.columns import count_where, money_sum, percentage, safe_divide
from slotflow.functions.timeparts import week_start
from slotflow.operators.projections import last_n_days

# Weekday names, 1 = Sunday (Spark's dayofweek numbering).
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Heat-map column order, Monday first (the dashboard's order).
HEATMAP_DAY_ORDER = [2, 3, 4, 5, 6, 7, 1]


def daily_bookings_by_source(b: DataFrame) -> DataFrame:
    """A1 + A2: per (booking_date, source): bookings, distinct emails, active and cancelled
    counts, cancellation rate (%)."""
    agg = b.groupBy(F.col("booking_date"), F.col("marketing_channel").alias("source")).agg(
        F.count("invitee_uri").alias("total_bookings"),
        F.countDistinct("invitee_email").alias("unique_emails"),
        count_where(F.col("event_status") == F.lit("active")).alias("active_bookings"),
        count_where(F.col("invitee_canceled") == F.lit(True)).alias("cancelled_bookings"),
    )
    return agg.withColumn("cancellation_rate", percentage(F.col("cancelled_bookings"), F.col("total_bookings")))


def bookings_by_date_channel(b: DataFrame) -> DataFrame:
    """A3: bookings per (date, channel)."""
    return b.groupBy(F.col("booking_date").alias("date"), F.col("marketing_channel").alias("channel")).agg(
        F.count("invitee_uri").alias("total_bookings")
    )


def spend_by_date_channel(s: DataFrame) -> DataFrame:
    """A4: exact spend per (date, channel), DECIMAL(38,6)."""
    return s.groupBy("date", "channel").agg(money_sum("spend").alias("total_spend"))


def daily_trend(b: DataFrame) -> DataFrame:
    """A5: bookings per (date, source)."""
    return b.groupBy(F.col("booking_date").alias("date"), F.col("marketing_channel").alias("source")).agg(
        F.count("invitee_uri").alias("bookings_count")
    )


def channel_bookings(b: DataFrame, approximate: bool = False) -> DataFrame:
    """Per channel, bookings and distinct leads (``approximate`` switches the distinct
    count to HyperLogLog++ for very high cardinality)."""
    leads = F.approx_count_distinct("invitee_email") if approximate else F.countDistinct("invitee_email")
    return b.groupBy("marketing_channel").agg(
        F.count("invitee_uri").alias("total_bookings"), leads.alias("unique_leads")
    )


def channel_spend(s: DataFrame) -> DataFrame:
    """Exact spend per channel."""
    return s.groupBy("channel").agg(money_sum("spend").alias("total_spend"))


def booking_time_slots(b: DataFrame) -> DataFrame:
    """Bookings per (hour, day of week, channel)."""
    return b.groupBy("booking_hour", "booking_day_of_week", "marketing_channel").agg(
        F.count("invitee_uri").alias("bookings_count")
    )


def weekly_meetings(b: DataFrame) -> DataFrame:
    """A9, first level: meetings per (host, ISO week starting Monday)."""
    hosted = b.filter(F.col("host_email").isNotNull() & F.col("scheduled_event_start_time").isNotNull())
    return hosted.groupBy(
        "host_email", "host_name", week_start(F.col("scheduled_event_start_time")).alias("week_start")
    ).agg(F.count(F.lit(1)).alias("meetings"))


def employee_meeting_load(b: DataFrame) -> DataFrame:
    """Per host, average / total / number / max / min of weekly meetings."""
    return weekly_meetings(b).groupBy("host_email", "host_name").agg(
        F.avg("meetings").alias("avg_meetings_per_week"),
        F.sum("meetings").alias("total_meetings"),
        F.count(F.lit(1)).alias("weeks_active"),
        F.max("meetings").alias("max_meetings_in_week"),
        F.min("meetings").alias("min_meetings_in_week"),
    )


def weekly_trend(daily: DataFrame) -> DataFrame:
    """A10: weekly volume by source from the daily trend (A5), weeks start on Monday."""
    return daily.groupBy(week_start(F.col("date")).alias("week_start"), "source").agg(
        F.sum("bookings_count").alias("bookings_count"),
        F.count(F.lit(1)).alias("days_with_bookings"),
    )


#: Decimals of means in the dashboard's KPIs: the mean itself is exact to the last bits, which
#: depend on the order of summation; results are rounded once, at output.
MEAN_DECIMALS = 6


def kpi_summary(attr: DataFrame) -> DataFrame:
    """One row over the channel attribution table: total bookings, total spend, mean
    cost per booking over channels that have one, total leads."""
    return attr.agg(
        F.sum("total_bookings").alias("total_bookings"),
        money_sum("total_spend").cast("double").alias("total_spend"),
        F.round(F.avg("cost_per_booking"), MEAN_DECIMALS).alias("avg_cost_per_booking"),
        F.sum("unique_leads").alias("unique_leads"),
    )


def kpi_period_delta(b: DataFrame, s: DataFrame, as_of: str, days: int) -> DataFrame:
    """KPIs of the ``days`` days ending at ``as_of`` against the ``days`` before, with
    the change in percent. One pass per input: both periods are conditional aggregates."""
    end = F.lit(as_of).cast("date")
    cur_start = F.date_sub(end, days)
    prev_start = F.date_sub(end, 2 * days)

    def period(c):
        return (
            F.when((c > cur_start) & (c <= end), F.lit("current"))
            .when((c > prev_start) & (c <= cur_start), F.lit("previous"))
        )

    # Both periods together are the last 2 x days: a literal range (and, on partitioned silver,
    # a year/month partition filter) before the rows are tagged with their period.
    b = last_n_days(b, "booking_date", 2 * days, as_of)
    s = last_n_days(s, "date", 2 * days, as_of)
    bp = b.withColumn("_p", period(F.col("booking_date"))).filter(F.col("_p").isNotNull())
    sp = s.withColumn("_p", period(F.col("date"))).filter(F.col("_p").isNotNull())
    # One global aggregate over the union of the inputs (no join between them). Distinct
    # leads come from a distinct (period, email) set, reduced map-side before its shuffle,
    # instead of two distinct aggregates (which Spark would plan as an Expand of every row).
    leads = bp.select("_p", "invitee_email").distinct()
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    rows = (
        bp.select("_p", F.lit("b").alias("_k"), "invitee_uri", null_s.alias("invitee_email"), null_d.alias("spend"))
        .unionByName(sp.select("_p", F.lit("s").alias("_k"), null_s.alias("invitee_uri"), null_s.alias("invitee_email"), "spend"))
        .unionByName(leads.select("_p", F.lit("e").alias("_k"), null_s.alias("invitee_uri"), "invitee_email", null_d.alias("spend")))
    )
    cur, prev = F.col("_p") == "current", F.col("_p") == "previous"
    out = rows.agg(
        count_where(cur & F.col("invitee_uri").isNotNull()).alias("bookings_current"),
        count_where(prev & F.col("invitee_uri").isNotNull()).alias("bookings_previous"),
        F.coalesce(money_sum(F.when(cur, F.col("spend"))), F.lit(0)).cast("double").alias("spend_current"),
        F.coalesce(money_sum(F.when(prev, F.col("spend"))), F.lit(0)).cast("double").alias("spend_previous"),
        count_where(cur & F.col("invitee_email").isNotNull()).alias("leads_current"),
        count_where(prev & F.col("invitee_email").isNotNull()).alias("leads_previous"),
    )
    out = out.withColumns(
        {
            "cpb_current": safe_divide(F.col("spend_current"), F.col("bookings_current")),
            "cpb_previous": safe_divide(F.col("spend_previous"), F.col("bookings_previous")),
        }
    )

    def change(cur, prev):
        return F.when(F.col(prev) > 0, (F.col(cur) - F.col(prev)) / F.col(prev) * F.lit(100))

    return out.withColumns(
        {
            "bookings_change_pct": change("bookings_current", "bookings_previous"),
            "spend_change_pct": change("spend_current", "spend_previous"),
            "cpb_change_pct": change("cpb_current", "cpb_previous"),
            "leads_change_pct": change("leads_current", "leads_previous"),
        }
    )


def overall_cpb(cpb: DataFrame) -> DataFrame:
    """Per channel, total spend / total bookings (ratio of sums), sorted ascending."""
    agg = cpb.groupBy("channel").agg(
        money_sum("total_spend").cast("double").alias("total_spend"),
        F.sum("total_bookings").alias("total_bookings"),
    )
    return agg.withColumn("cpb", safe_divide(F.col("total_spend"), F.col("total_bookings"))).orderBy(
        F.col("cpb").asc_nulls_last(), F.col("channel").asc_nulls_first()
    )


def booking_heatmap(t: DataFrame) -> DataFrame:
    """Hour x weekday matrix of bookings, zeros filled, Monday..Sunday columns. The pivot
    values are given, so Spark needs no extra job to discover them."""
    pivot = t.groupBy("booking_hour").pivot("booking_day_of_week", HEATMAP_DAY_ORDER).agg(F.sum("bookings_count"))
    pivot = pivot.fillna(0, subset=[str(d) for d in HEATMAP_DAY_ORDER])
    return pivot.select("booking_hour", *[F.col(str(d)).alias(WEEKDAY_NAMES[d - 1]) for d in HEATMAP_DAY_ORDER])


def hourly_bookings(t: DataFrame) -> DataFrame:
    """A15."""
    return t.groupBy("booking_hour").agg(F.sum("bookings_count").alias("bookings_count"))


def dow_bookings(t: DataFrame) -> DataFrame:
    """Bookings per weekday with the weekday name."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    agg = t.groupBy("booking_day_of_week").agg(F.sum("bookings_count").alias("bookings_count"))
    return agg.withColumn("day_name", F.try_element_at(names, F.col("booking_day_of_week")))


def meeting_load_kpis(m: DataFrame) -> DataFrame:
    """Total meetings, busiest week of any host, mean of the hosts' weekly averages."""
    return m.agg(
        F.sum("total_meetings").alias("total_meetings"),
        F.max("max_meetings_in_week").alias("max_meetings_in_week"),
        F.round(F.avg("avg_meetings_per_week"), MEAN_DECIMALS).alias("avg_meetings_per_week"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (each count is a metadata-friendly scan)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_sources(b: DataFrame) -> DataFrame:
    """A20."""
    return b.select(F.col("marketing_channel").alias("source")).distinct()


def batch_outcome(df: DataFrame, error_col: str = "error") -> DataFrame:
    """Processed / failed counts of a decoded batch."""
    return df.agg(
        count_where(F.col(error_col).isNull()).alias("processed"),
        count_where(F.col(error_col).isNotNull()).alias("failed"),
    )



def nest_spend(s: DataFrame, record: Column | None = None) -> DataFrame:
    """Spend rows as ``{records, record_count}`` documents, one per (date, channel) and
    source file, and each of its parts if a file has several: a document is never larger than the
    part of one file that it comes from.
    ``record`` is what the array holds (default: all columns). Null keys have documents too."""
    keys = [c for c in ("date", "channel", "source_file", "part") if c in s.columns]
    record = F.struct(*s.columns) if record is None else record
    return s.groupBy(*keys).agg(F.collect_list(record).alias("records"), F.count(F.lit(1)).alias("record_count"))
