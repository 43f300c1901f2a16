"""Structured Streaming entry points."""

from courtline.streaming.ingest import PAGE_LANDING_SCHEMA, start_page_ingest  # noqa: F401
