"""DataFrame operators: ``tables`` (relational), ``features`` (text features), ``stemming`` (vocabulary job)."""
