"""DataFrame → DataFrame operators: ingest, quality, gold, indicators, window stats, marts, serving."""
