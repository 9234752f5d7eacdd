"""Where rows come from: event streams, tables, seeds, logs, and order tables."""
