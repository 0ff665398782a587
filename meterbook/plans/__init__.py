"""Writing: the incremental upsert and the whole pipeline."""
