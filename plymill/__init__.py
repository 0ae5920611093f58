"""Game-log analytics on Spark: text archives to cleaned tables, aggregates, checks and models."""
