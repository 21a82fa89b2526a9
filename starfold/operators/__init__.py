"""DataFrame operators: de-duplication, lookups, keys, merge, quality, profiling, calendar."""
