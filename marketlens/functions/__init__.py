"""Column-level helpers (scalar expressions, time grids)."""
