"""DataFrame -> DataFrame operators: dedup, upsert, metrics, stats, quality, HTML."""
