"""Column expressions (built-in functions only; no UDFs)."""
