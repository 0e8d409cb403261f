"""DataFrame -> DataFrame operators: dedup, merges, staging, marts, checks."""
