"""Pipeline configuration (the reference's job arguments, validated non-empty)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    bronze_root: str
    silver_root: str
    gold_root: str
    database: str
    # Tracked event-type URL -> marketing channel (the webhook allow-list).
    event_type_channels: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in ("bronze_root", "silver_root", "gold_root", "database"):
            value = getattr(self, name)
            if not value or not str(value).strip():
                raise ValueError(f"missing required parameter: {name}")

    @property
    def bronze_bookings(self) -> str:
        return f"{self.bronze_root.rstrip('/')}/bookings"

    @property
    def bronze_spend(self) -> str:
        return f"{self.bronze_root.rstrip('/')}/marketing_spend"

    @property
    def bookmarks(self) -> str:
        return f"{self.silver_root.rstrip('/')}/_bookmarks"

    @property
    def spend_dead_letters(self) -> str:
        return f"{self.bronze_root.rstrip('/')}/spend_dead_letters"

    @property
    def silver_bookings(self) -> str:
        return f"{self.silver_root.rstrip('/')}/bookings_silver"

    @property
    def silver_spend(self) -> str:
        return f"{self.silver_root.rstrip('/')}/marketing_spend_silver"

    @property
    def gold_metrics(self) -> str:
        return f"{self.gold_root.rstrip('/')}/metrics"

    @property
    def run_log(self) -> str:
        return f"{self.silver_root.rstrip('/')}/_pipeline_runs"
