"""Plans: ``flows`` (the jobs M1-M11), ``registry`` (queries and oracle SQL), ``sql`` (Spark SQL
statements), ``jobs`` and ``cli`` (command-line entry points)."""
