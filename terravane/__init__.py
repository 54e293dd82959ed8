"""Spark-first engine for province-style map data: relational spatial operators, sources, sinks and plans."""
