"""Agro-climate analytics on Spark: weather snapshots in, farming campaigns out."""
