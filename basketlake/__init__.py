"""basketlake: retail transaction analytics written as Spark jobs."""
