"""A Spark-first engine that turns document collections into a clean, provenance-tracked knowledge graph."""

__version__ = "0.1.0"
