"""Change-data analytics on Spark: changelog, current state, business queries."""
