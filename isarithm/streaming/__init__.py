"""The one reduction that also runs on streams."""
