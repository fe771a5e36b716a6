"""Structured Streaming jobs: webhook intake, bronze writer, incremental silver, live counts."""
