"""Versioned terminology tables on Spark: load, derive, roll forward, check, print."""
