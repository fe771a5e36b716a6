"""Scans, tables on disk (partitioned writes, upserts, key index, catalog, run log), file
listings, staging in the checkpoint folder, and the test-data adapters."""
