"""Reading snapshots, message logs and table metadata."""
