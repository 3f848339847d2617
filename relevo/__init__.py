"""relevo: search-relevance feature building and modelling on Spark.

Subpackages
-----------
sources    typed CSV reads and the logical tables built from the driver's Parquet tables
sinks      CSV writers and printable result lines
functions  column expressions (cleaning, words, hit counts) and the one-word stemmer helper
operators  DataFrame -> DataFrame operators (joins, flattening, features, stemming job)
models     seeded Spark ML estimators, scoring, coefficients, RMSE
plans      the user-visible flows and the registry of queries with their SQL oracles
streaming  intentionally empty: the reference has no streaming work
"""

__version__ = "0.1.0"
