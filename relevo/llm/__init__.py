"""Operators of a training-data pipeline: tokens, near-duplicates, packing, language, archives.

Nothing else in the library imports this subpackage; it may be deleted as a whole. Operators take
DataFrames and column names, select only the columns they name (other columns never clash) and
return DataFrames keyed by the id column.
"""
