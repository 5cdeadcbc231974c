"""siltgate: ingestion, validation and loading of messy records as Spark jobs."""
