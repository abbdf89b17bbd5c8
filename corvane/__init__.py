"""Document and metrics analytics as Spark plans."""
