"""Product-view analytics on Spark: enrichment, star schema, daily marts, streaming load."""
