"""Model graph, medallion run and query registry."""
