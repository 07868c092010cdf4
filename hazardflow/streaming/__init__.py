"""The batch steps on streams: ingest, upsert, live counts, alerts."""
