"""Composite plans: normalizers, gold metrics (per metric and from roll-ups), webhook plans,
read models, batch jobs, and the query registry with its DuckDB oracle SQL."""
