"""Table profiling, high-watermark ingestion and event-time streaming on Spark."""
