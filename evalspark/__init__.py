"""evalspark: evaluation results as Spark DataFrame jobs."""
