"""Column functions: rules, time buckets, null-safe aggregates and scores."""
