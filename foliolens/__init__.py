"""Document outlines and persona-driven section ranking as Spark jobs."""
