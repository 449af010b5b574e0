"""Sources (landing scan, phrase files, manifests) and sinks (typed Parquet,
manifest JSON, quarantine, raw retention)."""
