"""Column-level helpers (pure Spark expressions, no Python UDFs)."""
