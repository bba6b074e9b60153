"""Customer-contact ingestion and service KPIs as Spark DataFrame jobs."""
