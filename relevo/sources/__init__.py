"""Sources: ``tables`` (logical tables from the driver's Parquet) and ``csv`` (typed CSV reads)."""
