"""Manufacturing-finance analytics as PySpark DataFrame jobs."""
