"""Full-text indexing, ranking and evaluation as Spark DataFrame jobs."""
