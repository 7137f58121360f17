"""millrace: layered analytics warehouse jobs written as Spark DataFrame functions.

functions/   column expressions (cleaning, casts, time)
operators/   relation-level building blocks (joins, rollups, SCD2, checks)
sources/     Parquet exports, raw views, versioned history
plans/       the star schema: staging specs, models, checks, registered queries
"""
