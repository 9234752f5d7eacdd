"""Dataset operators: ingest, quality checks, incremental loads, joins, derivation."""
