"""Column-level building blocks (no shuffle, no Python worker)."""
