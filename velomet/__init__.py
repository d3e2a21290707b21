"""Trips x weather analytics as Spark DataFrame jobs.

Layout
------
functions   column expressions (cleaning, calendar, units, bands, distance)
sources     files and catalog: manifests, raw CSV, typed Parquet, views, snapshots
operators   DataFrame -> DataFrame building blocks
plans       marts and analyses composed from the operators
streaming   the trip marts kept up to date from a growing Parquet folder
"""
