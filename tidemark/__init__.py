"""tidemark: snapshot and change-data ingestion as PySpark DataFrame jobs."""
