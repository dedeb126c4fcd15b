"""End-of-day market analytics on Spark."""
