"""Food-delivery analytics as Spark jobs."""
