"""Column -> Column building blocks (all built-in Spark expressions)."""
