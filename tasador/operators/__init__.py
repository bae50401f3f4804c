"""DataFrame operators: cleaning, indexes, lookups, radius search, serving."""
