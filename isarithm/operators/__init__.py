"""Lazy operators over DataFrames: grids, stencils, spatial joins, meshes, selection, reports."""
