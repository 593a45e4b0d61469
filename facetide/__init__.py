"""Face-attribute data preparation, training and scoring as Spark jobs."""
