"""Structured Streaming forms: continuous ingest, event chain, enrichment."""
