"""Structured Streaming jobs.  They run the batch operators wherever Spark allows it."""
