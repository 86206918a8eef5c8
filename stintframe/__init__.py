"""Race-session analytics expressed as PySpark DataFrame jobs."""
