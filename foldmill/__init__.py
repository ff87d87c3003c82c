"""foldmill: tabular machine-learning pipelines as Spark jobs."""
