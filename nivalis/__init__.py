"""Spark jobs for gridded snow time series."""
