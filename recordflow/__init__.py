"""Record ingestion, conformance, feature building and scoring on PySpark."""
