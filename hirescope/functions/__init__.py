"""Column -> Column helpers (all JVM-side expressions, no Python UDFs)."""
