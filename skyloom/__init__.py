"""Gridded forecast data on Spark: manifests, cells, axes, stores, checks and runs as DataFrames."""
