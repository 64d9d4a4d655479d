"""Direct-response campaign analytics as Spark DataFrame jobs."""
