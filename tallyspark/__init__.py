"""Catalogue analytics on Spark: parsing, derived tables, distribution statistics and audit queues."""
