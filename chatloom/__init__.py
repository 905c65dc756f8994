"""Training-sample tables, rule rewards and rollout diagnostics as Spark jobs."""
