"""Named tables kept as Parquet snapshots, and JSON record files."""
