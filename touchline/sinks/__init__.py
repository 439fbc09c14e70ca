"""Writing snapshots, clustered tables and published versions."""
