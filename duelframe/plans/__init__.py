"""Plans: the three pipeline entries (clean, features, train), the query
catalogue used by ``__spark_entry__`` and its SQL oracles."""
