"""Column expressions: geometry, map projections, texts of reports."""
