"""Zone pipelines on Spark: clean, unnest, deduplicate, upsert, enrich, publish."""
