"""Document ingestion, hybrid retrieval and corpus preparation on PySpark."""
