"""loomspan: located features, scored evidence and sequence analytics as Spark DataFrame jobs."""
