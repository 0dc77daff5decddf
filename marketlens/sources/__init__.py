"""Table sources: logical schemas, the derived test mart, CSV ingest and catalog helpers."""
