"""DataFrame operators: pair extraction, resolution, reports and shards."""
