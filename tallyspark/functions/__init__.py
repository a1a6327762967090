"""Reusable column expressions and join helpers (built-in Spark functions only)."""
