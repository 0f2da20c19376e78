"""Plans: registering a source's tables, and rewrites that Spark's data source API has no hook for."""
