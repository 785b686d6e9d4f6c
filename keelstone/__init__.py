"""A governed, event-driven lakehouse on Spark: ingestion, layers, data products, movement analytics and serving."""
