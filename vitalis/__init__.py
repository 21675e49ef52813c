"""Health-analytics operators expressed as Spark DataFrame plans."""
