"""isarithm: gridded, geometric and tabular analytics as lazy Spark DataFrame operators."""
