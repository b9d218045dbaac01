"""DataFrame -> DataFrame operators: cleaning, indexing, lookups, keyed tables."""
