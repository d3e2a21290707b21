"""Files and catalog objects: manifests, raw CSV, typed Parquet, views and snapshots."""
