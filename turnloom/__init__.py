"""turnloom: a Spark-first engine for broadcast transcript analytics."""

__version__ = "0.1.0"
