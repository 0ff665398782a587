"""Usage-billing analytics as Spark jobs: rules, matching, rating, minimums, allocation, reconciliation."""
