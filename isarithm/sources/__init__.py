"""Readers and writers of the map formats, as explicit schemas over files that Spark lists."""
