"""Speech-corpus building, checking and detection analytics as Spark DataFrame jobs."""
