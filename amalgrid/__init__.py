"""A PySpark-native engine for cleaning, matching and grouping names and texts at scale."""

__version__ = "0.1.0"
