"""Document-layout analytics as Spark jobs."""
