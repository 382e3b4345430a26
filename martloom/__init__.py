"""martloom: Spark operators for layered data products (staging, warehouse, vault, marts)."""

__version__ = "0.1.0"
