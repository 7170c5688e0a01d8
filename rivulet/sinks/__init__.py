"""Writing message logs and target tables."""
