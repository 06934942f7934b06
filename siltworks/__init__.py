"""Web-corpus mining on Spark: deduplication, language and quality scoring, metadata and queries."""
