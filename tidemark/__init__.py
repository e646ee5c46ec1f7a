"""Timeline-annotation analytics on PySpark."""
