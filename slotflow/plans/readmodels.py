"""Dashboard read models (P19, S22) and second-stage roll-ups (A11-A18, W10), all on Spark.

A read model is a gold table without its bookkeeping columns, under the dashboard's names and
in its order. It is defined from the gold schema, so a measure added to gold shows up here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.operators import aggregations as A
from slotflow.operators.ordering import leaderboard, sort_recent_first
from slotflow.operators.windows import cumulative_bookings

#: Columns of gold tables that describe a row's date or origin again.
BOOKKEEPING = {"year", "month", "day", "day_of_week", "week_of_year", "metric_name", "calculated_at"}


@dataclass(frozen=True)
class ReadModel:
    table: str
    names: dict[str, str] = field(default_factory=dict)  # gold name -> dashboard name
    hidden: frozenset[str] = frozenset()
    newest_first_by: str | None = None  # date column is "date"; then this column
    largest_first: str | None = None

    def of(self, gold: DataFrame) -> DataFrame:
        shown = [c for c in gold.columns if c not in BOOKKEEPING | self.hidden]
        view = gold.select(*[F.col(c).alias(self.names.get(c, c)) for c in shown])
        if self.newest_first_by:
            return sort_recent_first(view, "date", self.newest_first_by)
        return leaderboard(view, self.largest_first) if self.largest_first else view


READ_MODELS = {
    "v_daily_bookings": ReadModel("daily_bookings_by_source", {"booking_date": "date"}, frozenset({"unique_emails"}), newest_first_by="source"),
    "v_cost_per_booking": ReadModel("cost_per_booking", newest_first_by="channel"),
    "v_channel_attribution": ReadModel("channel_attribution", largest_first="total_bookings"),
    "v_booking_time": ReadModel("booking_time_analysis", hidden=frozenset({"total_channel_bookings"})),
    "v_meeting_load": ReadModel("employee_meeting_load", largest_first="avg_meetings_per_week"),
}


def register_gold_views(tables: dict[str, DataFrame]) -> None:
    """Expose gold DataFrames to SQL under their table names (session-scoped temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Query gold tables by name."""
    return spark.sql(sql)


def read_model(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """One of the dashboard read models, over temp views (``database`` None) or over the
    gold tables of a catalog database (names qualified, so a temp view of the same name
    cannot shadow them)."""
    model = READ_MODELS[name]
    where = f"`{database}`." if database else ""
    return model.of(run_sql(spark, f"SELECT * FROM {where}{model.table}"))


def cumulative_daily_bookings(daily: DataFrame) -> DataFrame:
    """Running total of daily bookings per source (area-chart data)."""
    return cumulative_bookings(daily.withColumnRenamed("booking_date", "date"))


kpi_summary = A.kpi_summary
kpi_period_delta = A.kpi_period_delta
overall_cpb = A.overall_cpb
booking_heatmap = A.booking_heatmap
hourly_bookings = A.hourly_bookings
dow_bookings = A.dow_bookings
meeting_load_kpis = A.meeting_load_kpis
