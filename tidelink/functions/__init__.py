"""Column-expression helpers (native Spark functions only)."""
