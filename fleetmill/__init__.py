"""Fleet reliability analytics on Spark: cycle aggregates, causal features, cohorts, serving."""
