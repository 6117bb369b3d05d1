"""Column and schema helpers."""
