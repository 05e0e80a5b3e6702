"""panelspark: Spark-native operators for daily panel tables (place x date x segment)."""

__version__ = "0.1.0"
