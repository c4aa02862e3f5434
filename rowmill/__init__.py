"""Relational tables at scale on Spark: database sources and sinks, reads, table changes, column typing."""
