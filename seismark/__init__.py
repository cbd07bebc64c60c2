"""Event-feed ingestion and analytics expressed as Spark DataFrame jobs."""
